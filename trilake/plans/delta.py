"""D1, D3 and D5 maintained from what landings change, instead of computed anew.

The keyed current tables (``streaming.keyed``) know, for every commit, which rows came in and
which winners went out. An answer that is built from sums can follow: the winner that went
out is taken back, the one that came in is added. Sums are kept as limbs (``functions.exact``),
so adding and taking back is exact and the answers equal the full job's.

* D1 and D3: sums and counts by genre and by release year.
* D5: a title's contribution depends on its own row and on its reviews' mean. Per title the
  sum and count of its ratings are kept in a keyed table of their own; the titles that a
  landing touches (by their own row or by a review) are taken back as they were and added
  as they are. Only those titles' buckets are read. The coefficients come from the sums of
  x, y, x*x, y*y and x*y.

The state is one version of a zone, published once per update; it names the versions it is
built from, so an update that failed half-way is simply run again. If the exchange rate has
changed, every converted amount has, and the state is built anew from the current tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilake.functions.exact import LIMBS, join_limbs, limbs
from trilake.operators.finance import financial_metrics
from trilake.operators.multivalue import token_rows
from trilake.plans import questions as Q
from trilake.sources.versions import Zone
from trilake.streaming.keyed import KeyedTable

#: Sums that a coefficient needs of its pair-complete rows.
_MOMENTS = ("x", "y", "xx", "yy", "xy")
#: Share of a spread below which a side counts as constant (sums of squares cancel).
_FLAT = 1e-13


def _names(measure: str) -> list[str]:
    return [f"{measure}_{i}" for i in range(LIMBS)]


def _signed(measures: dict[str, Column]) -> list[Column]:
    """Aggregates: limbs and count of every measure, rows weighing their ``_sign``."""
    out = []
    for name, column in measures.items():
        value = column.cast("double")
        out += [F.coalesce(F.sum(part * F.col("_sign")), F.lit(0)).alias(n) for n, part in zip(_names(name), limbs(value))]
        out.append(F.sum(F.when(value.isNotNull(), F.col("_sign")).otherwise(0)).alias(f"{name}_n"))
    return out


def _added(state: DataFrame | None, change: DataFrame, key: list[str]) -> DataFrame:
    """The state with a change added; groups without rows go."""
    both = change if state is None else state.unionByName(change)
    sums = [c for c in change.columns if c not in key]
    return both.groupBy(*key).agg(*[F.sum(c).alias(c) for c in sums]).where("rows <> 0")


def _total(measure: str) -> Column:
    return F.when(F.col(f"{measure}_n") > 0, join_limbs([F.col(c) for c in _names(measure)]))


def _mean(measure: str) -> Column:
    return _total(measure) / F.nullif(F.col(f"{measure}_n"), F.lit(0))


class MaintainedAnswers:
    """The answers under ``root``, following the keyed tables of titles, reviews and rates."""

    def __init__(self, spark: SparkSession, root: str, movies: KeyedTable, reviews: KeyedTable, exchange: KeyedTable, code: str = "COP"):
        self.spark, self.zone, self.code = spark, Zone(spark, root), code
        self.movies, self.reviews, self.exchange = movies, reviews, exchange
        self.ratings = KeyedTable(spark, f"{root.rstrip('/')}/title_ratings", "tmdb_id", ["seen"], movies.buckets)

    # -- following -----------------------------------------------------------------------

    def _rate(self, number: int | None) -> float | None:
        rows = self.exchange.rows(number) if number else None
        first = rows.where(F.col("currency") == self.code).select("rate").first() if rows is not None else None
        return first["rate"] if first else None

    def _with_money(self, rows: DataFrame) -> DataFrame:
        rates = self.spark.createDataFrame([(self.code, self._now["rate"])] if self._now["rate"] is not None else [], "currency string, rate double")
        absent = {c: F.lit(None).cast(t) for c, t in (("release_year", "int"), ("vote_average", "double"), ("genres", "string")) if c not in rows.columns}
        return financial_metrics(rows.withColumns(absent) if absent else rows, rates, self.code)

    def _moved(self, table: KeyedTable, since: int, upto: int) -> DataFrame | None:
        """Signed rows of the commits after ``since``; of all current rows if there is none."""
        if not since:
            rows = table.rows(upto) if upto else None
            return None if rows is None else rows.withColumn("_sign", F.lit(1))
        out = None
        for number in range(since + 1, upto + 1):
            change = table.changes(number)
            if change is not None:
                out = change if out is None else out.unionByName(change, allowMissingColumns=True)
        return out

    def update(self) -> bool:
        """Follow the tables to their newest versions; False if nothing has changed."""
        number = lambda t: (t.version() or _NOTHING).number
        now = {"movies": number(self.movies), "reviews": number(self.reviews), "exchange": number(self.exchange)}
        now["rate"] = self._rate(now["exchange"])
        base = self.zone.version()
        if base is not None and all(base.meta[k] == now[k] for k in ("movies", "reviews", "rate")):
            return False
        self._now = now
        afresh = base is None or base.meta["rate"] != now["rate"]
        was = {"movies": 0, "reviews": 0} if afresh else base.meta
        draft = self.zone.draft()
        old = (lambda name: None) if afresh else self.zone.pinned(base.number).table
        titles = self._moved(self.movies, was["movies"], now["movies"])
        if titles is not None:
            titles = self._with_money(titles)
            draft.write(_added(old("genres"), self._genre_change(titles), ["genre"]), "genres")
            draft.write(_added(old("years"), self._year_change(titles), ["release_year"]), "years")
        ratings = self._follow_ratings(now)
        pairs = self._pair_change(titles, was, now, 0 if afresh else base.meta["ratings"], ratings)
        if pairs is not None:
            draft.write(_added(old("pairs"), pairs, ["pair"]), "pairs")
        self.zone.commit(draft.base, ({} if afresh else base.tables) | draft.new, now | {"ratings": ratings})
        return True

    def _genre_change(self, titles: DataFrame) -> DataFrame:
        measured = titles.where("revenue_usd > 0 AND revenue_cop IS NOT NULL")
        rows = token_rows(measured, "genres", "genre", keep=["tmdb_id", "revenue_usd", "revenue_cop", "_sign"], first="first")
        return rows.groupBy("genre").agg(F.sum("_sign").alias("rows"), F.sum(F.when(F.col("first"), F.col("_sign")).otherwise(0)).alias("n_movies"),
                                         *_signed({m: F.col(m) for m in ("revenue_usd", "revenue_cop")}))

    def _year_change(self, titles: DataFrame) -> DataFrame:
        known = titles.dropna(subset=["revenue_usd", "revenue_cop", "release_year"])
        return known.groupBy("release_year").agg(F.sum("_sign").alias("rows"), *_signed({m: F.col(m) for m in ("revenue_usd", "revenue_cop", "roi_pct")}))

    # -- D5 ------------------------------------------------------------------------------

    def _follow_ratings(self, now: dict) -> int:
        """Bring the per-title rating sums to the reviews' newest version; returns the version
        of the sums. They are applied by the reviews' number, so a repeat changes nothing."""
        state = self.ratings.version()
        since = state.meta["applied"].get("reviews", 0) if state else 0
        moved = self._moved(self.reviews, since, now["reviews"]) if now["reviews"] > since else None
        if moved is not None:
            change = moved.where("tmdb_id IS NOT NULL").groupBy("tmdb_id").agg(F.sum("_sign").alias("rows"), *_signed({"rating": F.col("rating")}))
            touched = change.select("tmdb_id")
            before = self._of_titles(self.ratings, state.number, touched) if state else None
            if before is not None:
                change = before.drop("seen").unionByName(change)
            sums = [c for c in change.columns if c != "tmdb_id"]
            # a title whose reviews have all gone keeps a row of zeros: it replaces the old one
            self.ratings.merge(change.groupBy("tmdb_id").agg(*[F.sum(c).alias(c) for c in sums]).withColumn("seen", F.lit(now["reviews"])),
                               "reviews", now["reviews"])
        return (self.ratings.version() or _NOTHING).number

    def _of_titles(self, table: KeyedTable, number: int, titles: DataFrame) -> DataFrame | None:
        """A table's rows of some titles: only the buckets they fall in are read."""
        version = table.version(number) if number else None
        if version is None:
            return None
        buckets = [r["b"] for r in titles.select(table.bucket_of("tmdb_id", version).alias("b")).distinct().collect()]  # at most the buckets
        return table.rows(number, buckets).join(titles, "tmdb_id", "left_semi")

    def _contributions(self, number: int, ratings: int, titles: DataFrame | None, sign: int) -> DataFrame | None:
        """pair, x, y, _sign of the titles (all of them, if None) in these versions."""
        if not number:
            return None
        rows = self.movies.rows(number) if titles is None else self._of_titles(self.movies, number, titles)
        means = None
        if ratings:
            means = self.ratings.rows(ratings) if titles is None else self._of_titles(self.ratings, ratings, titles)
        if means is None:
            means = self.spark.createDataFrame([], "tmdb_id long, avg_review_rating double")
        else:
            means = means.where(F.col("rating_n") >= Q.MIN_REVIEWS).select("tmdb_id", _mean("rating").alias("avg_review_rating"))
        rated = Q._rated_titles(self._with_money(rows), means, "vote_average", "revenue_usd", "profit_usd", "roi_pct")
        pairs = F.array(*[F.struct(F.lit(name).alias("pair"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for name, x, y in Q.CORR_PAIRS])
        return rated.select(F.inline(pairs)).where("x IS NOT NULL AND y IS NOT NULL").withColumn("_sign", F.lit(sign))

    def _pair_change(self, titles: DataFrame | None, was: dict, now: dict, ratings_then: int, ratings_now: int) -> DataFrame | None:
        if not was["movies"]:  # everything is new
            both = self._contributions(now["movies"], ratings_now, None, 1)
        else:
            touched = [t.select("tmdb_id") for t in (titles, self._moved(self.reviews, was["reviews"], now["reviews"])) if t is not None]
            if not touched:
                return None
            ids = touched[0] if len(touched) == 1 else touched[0].union(touched[1])
            ids = ids.where("tmdb_id IS NOT NULL").distinct()
            both = self._contributions(was["movies"], ratings_then, ids, -1).union(self._contributions(now["movies"], ratings_now, ids, 1))
        if both is None:
            return None
        products = {"x": F.col("x"), "y": F.col("y"), "xx": F.col("x") * F.col("x"), "yy": F.col("y") * F.col("y"), "xy": F.col("x") * F.col("y")}
        return both.groupBy("pair").agg(F.sum("_sign").alias("rows"), *_signed(products))

    # -- answers -------------------------------------------------------------------------

    def _state(self, name: str) -> DataFrame | None:
        version = self.zone.version()
        return self.zone.pinned(version.number).table(name) if version and name in version.tables else None

    def revenue_by_genre(self) -> DataFrame:
        """D1."""
        money = ("revenue_usd", "revenue_cop")
        shown = [c for m in money for c in (F.round(_total(m), 2).alias(f"{m}_total"), F.round(_mean(m), 2).alias(f"{m}_avg"))]
        return self._state("genres").select("genre", "n_movies", *shown).sort(F.desc("revenue_usd_total"), "genre")

    def revenue_by_year(self, decade_from: int = Q.DECADE_FROM, min_titles: int = 5) -> DataFrame:
        """D3."""
        rows = self._state("years").where((F.col("release_year") >= decade_from) & (F.col("rows") >= min_titles))
        return rows.select("release_year", F.col("rows").alias("n_movies"), F.round(_total("revenue_usd"), 2).alias("revenue_usd_total"),
                           F.round(_total("revenue_cop"), 2).alias("revenue_cop_total"), F.round(_mean("roi_pct"), 2).alias("avg_roi_pct")).sort("release_year")

    def ratings_correlations(self, digits: int = 4) -> DataFrame:
        """D5."""
        n = F.col("rows").cast("double")
        s = {m: _total(m) for m in _MOMENTS}
        spread = {side: n * s[side * 2] - s[side] * s[side] for side in ("x", "y")}
        flat = F.lit(False)
        for side in ("x", "y"):
            flat |= spread[side] <= _FLAT * n * s[side * 2]
        value = F.when(~flat, F.try_divide(n * s["xy"] - s["x"] * s["y"], F.sqrt(spread["x"]) * F.sqrt(spread["y"])))
        each = self._state("pairs").select("pair", F.round(value, digits).alias("r"))
        return each.agg(*[F.max(F.when(F.col("pair") == name, F.col("r"))).alias(name) for name, *_ in Q.CORR_PAIRS])


class _NOTHING:
    number = 0
