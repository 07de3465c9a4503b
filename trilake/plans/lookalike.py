"""Trusted-zone look-alikes derived by Spark from the driver's test tables.

The title tables of the lake are not in the test data, so the questions run on
tables Spark derives from the TPC-H-like tables, with the same column names and
meaning as the trusted zone. Everything is lazy and grows with the inputs:

* titles (movies)  = lineitem lines, one title per ``(order, line)`` key
  (``tmdb_id = l_orderkey * 100 + l_linenumber``; the test data repeats some keys,
  so the look-alike keeps one line per key with W1, latest ship date first, the
  other columns the title is built from as tie-break); revenue = ``l_extendedprice``; budget =
  ``l_quantity x p_retailprice``; release year = ship year; rating =
  ``l_discount x 100``; vote count = quantity.
* comma lists are row-local, so no list is ever built by aggregation: genres = the
  words of the part name (``small, ring``), directors = part brand and part type,
  cast = the line's supplier key.
* people           = supplier (``s_suppkey``, ``s_name``, ``s_acctbal``).
* movie_reviews    = events: review per event, title = line 1 of order ``user_id``
  (``user_id * 100 + 1``), rating = ``value / 49`` (a few fall above 10 and are
  nulled by the range rule); reviews of unknown titles are dropped by the semi-join.
* exchange         = rates documents parsed from ``events.props`` (``{"k": n}``),
  cleaned to one rate per currency; the target currency is ``K``.

Money stays ``decimal(18,2)`` (rates ``decimal(18,4)``) so sums are exact and
agree bit-for-bit with another engine; ratios are doubles like the reference.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilake.operators.dedupe import best_per_key
from trilake.operators.finance import add_profit_roi, convert_currency
from trilake.plans.trusted import clean_exchange, clean_people, clean_reviews
from trilake.session import shared_dir
from trilake.sources.rates import flatten_rates, parse_rates
from trilake.sources.versions import Conflict, SmallFiles, Zone

MONEY = "decimal(18,2)"
RATE = "decimal(18,4)"
FX_CODE = "K"
RATING_DIVISOR = 49.0


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


# Fixed value: title key = order key x 100 + line number (TPC-H line numbers are 1..7).
TITLE_KEY_FACTOR = 100
LINE_ORDER = ("l_shipdate", "l_extendedprice")
# Tie-break on the columns the title is built from: duplicates that tie on all of
# them give identical titles, so the unused columns need not be read at all.
LINE_TIES = ("l_partkey", "l_suppkey", "l_quantity", "l_discount")


def title_key(orderkey: str = "l_orderkey", linenumber: str = "l_linenumber"):
    return F.col(orderkey) * F.lit(TITLE_KEY_FACTOR) + F.col(linenumber)


def title_lines(spark: SparkSession, d: str) -> DataFrame:
    """One line per title key (W1) with its part attributes."""
    li = table(spark, d, "lineitem").withColumn("tmdb_id", title_key())
    li = best_per_key(li, "tmdb_id", *LINE_ORDER, ties=list(LINE_TIES))
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    return li.join(part, li.l_partkey == part.p_partkey, "inner")


def base_titles(spark: SparkSession, d: str) -> DataFrame:
    t = title_lines(spark, d)
    return t.select(
        "tmdb_id",
        F.concat(F.lit("Title "), F.col("tmdb_id").cast("string")).alias("title"),
        F.year("l_shipdate").cast("int").alias("release_year"),
        F.col("l_extendedprice").cast(MONEY).alias("revenue_usd"),
        (F.col("l_quantity").cast(MONEY) * F.col("p_retailprice").cast(MONEY)).cast(MONEY).alias("budget_usd"),
        (F.col("l_discount").cast(MONEY) * F.lit(100)).cast("double").alias("vote_average"),
        F.col("l_quantity").cast("int").alias("vote_count"),
        F.col("l_suppkey").cast("string").alias("cast_ids"),
        F.regexp_replace("p_name", " ", ", ").alias("genres"),
        F.concat_ws(",", "p_brand", "p_type").alias("directors"),
    )


def raw_rates(spark: SparkSession, d: str) -> DataFrame:
    """Rates rows as the raw zone holds them (all text)."""
    ev = table(spark, d, "events")
    docs = ev.select(parse_rates(F.col("props"), F.lit("USD"),
                                 F.date_format("ts", "yyyy-MM-dd")).alias("doc"))
    r = flatten_rates(docs, "doc")
    return r.select(F.col("currency"), F.col("rate").cast("string").alias("rate"), "base", "date")


def exchange(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned exchange table: one (highest) rate per currency. Only ``currency`` and
    ``rate`` are kept, which depend on the distinct documents alone, so each distinct
    ``props`` text is parsed once: the ``distinct`` is partially aggregated before
    its shuffle and the JSON parse runs on the few surviving rows, not on every event."""
    docs = (table(spark, d, "events").select("props").distinct()
            .select(parse_rates(F.col("props"), F.lit("USD")).alias("doc")))
    raw = flatten_rates(docs, "doc").select("currency", F.col("rate").cast("string").alias("rate"))
    ex = clean_exchange(raw)
    return ex.select("currency", F.col("rate").cast(RATE).alias("rate"))


def titles(spark: SparkSession, d: str, fx: DataFrame | None = None) -> DataFrame:
    """Trusted movies look-alike with profit, ROI and converted revenue."""
    if fx is None:
        return _titles(spark, d)
    return convert_currency(add_profit_roi(base_titles(spark, d)), fx, FX_CODE)


def _titles(spark: SparkSession, d: str) -> DataFrame:
    return convert_currency(add_profit_roi(base_titles(spark, d)), exchange(spark, d), FX_CODE)


def people(spark: SparkSession, d: str) -> DataFrame:
    """Trusted people look-alike, cleaned from supplier text columns."""
    s = table(spark, d, "supplier")
    raw = s.select(F.col("s_suppkey").cast("string").alias("tmdb_id"),
                   F.col("s_name").alias("name"),
                   F.col("s_acctbal").cast("string").alias("popularity"))
    return clean_people(raw)


def raw_reviews(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("review_id"),
        F.col("event_type").alias("author"),
        F.col("ts").cast("string").alias("created_at"),
        (F.col("user_id") * F.lit(TITLE_KEY_FACTOR) + F.lit(1)).cast("string").alias("tmdb_id"),
        (F.col("value") / F.lit(RATING_DIVISOR)).cast("string").alias("rating"),
    )


def reviews(spark: SparkSession, d: str) -> DataFrame:
    """Trusted reviews look-alike (T4): range rule, dedupe, only reviews of known
    titles (left-semi join on the title keys)."""
    known = table(spark, d, "lineitem").select(title_key().alias("tmdb_id"))
    return clean_reviews(raw_reviews(spark, d), known)


def trusted_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One of the five SQL-visible trusted tables, as a plan over the test tables."""
    if name == "movie_genres":
        from trilake.plans.trusted import genre_bridge
        return genre_bridge(titles(spark, d))
    return {"movies": titles, "people": people, "movie_reviews": reviews, "exchange": exchange}[name](spark, d)


def trusted(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """All five SQL-visible trusted tables (look-alikes)."""
    return {n: trusted_table(spark, d, n) for n in ("movies", "movie_genres", "people", "movie_reviews", "exchange")}


#: Test tables that a look-alike is built from.
SOURCES = {"movies": ("lineitem", "part", "events"), "movie_genres": ("lineitem", "part"), "people": ("supplier",),
           "movie_reviews": ("events", "lineitem"), "exchange": ("events",)}


def stored(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A look-alike from the trusted zone: the questions read stored tables, as they do in the
    lake. A table is written once in a session for an input folder, and again if the files it
    is built from (names, sizes, times) are others."""
    files = SmallFiles(spark)
    seen = hashlib.md5(repr([(t, files.stamps(f"{d.rstrip('/')}/{t}.parquet")) for t in SOURCES[name]]).encode()).hexdigest()
    zone = Zone(spark, shared_dir(spark, "lookalike", spark.sparkContext.applicationId, f"{name}-{seen}"))
    version = zone.version()
    if version is None:
        draft = zone.draft()
        draft.write(trusted_table(spark, d, name), name)
        try:
            version = draft.publish()
        except Conflict:  # another thread was faster
            version = zone.version()
    return zone.pinned(version.number).table(name)
