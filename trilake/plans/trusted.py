"""Raw -> trusted cleaning plans.

Each ``clean_*`` is a pure DataFrame -> DataFrame plan: one typed projection over
the raw string columns (P1-P5), row filters (F1-F3), value rules (P6-P9) and one
keep-one-per-key window (W1, one shuffle on the key with a map-side per-key limit).
``raw_to_trusted`` wires them to Parquet; cleaned titles are written once and read
back, so the bridge and the review filter do not recompute the CSV scan and the
dedupe shuffle (the reference re-ran that lineage three times).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trilake.functions.clean import code as clean_code, has_text, identifier, not_negative, three_way, typed, valid_id, within
from trilake.operators.dedupe import best_per_key
from trilake.operators.finance import financial_metrics
from trilake.operators.joins import keep_known
from trilake.operators.multivalue import bridge

# Column lists of the raw tables, as the reference's job names them.
MOVIE_TEXT = (
    "imdb_id", "title", "original_title", "original_language", "alternative_titles", "tagline",
    "overview", "release_date", "status", "genres", "keywords", "us_certification",
    "production_companies", "production_countries", "spoken_languages", "collection_name",
    "cast_names", "cast_ids", "cast_characters", "directors", "director_ids", "writers",
    "producers", "composers", "trailer_url", "similar_ids", "similar_titles", "recommended_ids",
    "recommended_titles", "poster_url", "poster_url_hd", "backdrop_url", "homepage",
    "watch_tr_flatrate", "watch_tr_rent", "watch_tr_buy", "watch_tr_free", "watch_tr_link",
    "watch_us_flatrate", "watch_us_rent", "watch_us_buy", "watch_us_free", "watch_us_link",
)
#: 64-bit ids.
TITLE_IDS = ("tmdb_id", "collection_id", "tvdb_id")
MOVIE_INT = ("release_year", "runtime_min", "vote_count")
MOVIE_DOUBLE = ("vote_average", "popularity", "budget_usd", "revenue_usd")
MOVIE_BOOL = ("has_trailer",)

TV_TEXT = (
    "imdb_id", "title", "original_title", "original_language", "alternative_titles", "tagline",
    "overview", "first_air_date", "last_air_date", "status", "show_type", "genres", "keywords",
    "networks", "network_ids", "origin_countries", "spoken_languages", "production_companies",
    "creators", "creator_ids", "cast_names", "cast_ids", "cast_characters", "writers",
    "similar_ids", "similar_titles", "recommended_ids", "recommended_titles", "poster_url",
    "poster_url_hd", "backdrop_url", "homepage", "watch_tr_flatrate", "watch_tr_rent",
    "watch_tr_buy", "watch_tr_free", "watch_tr_link", "watch_us_flatrate", "watch_us_rent",
    "watch_us_buy", "watch_us_free", "watch_us_link", "cert_tr", "cert_us",
)
TV_INT = ("release_year", "number_of_seasons", "number_of_episodes",
          "avg_episode_runtime", "season_count", "vote_count")
TV_DOUBLE = ("vote_average", "popularity")
TV_BOOL = ("in_production",)

PEOPLE_TEXT = (
    "imdb_id", "instagram_id", "twitter_id", "name", "also_known_as", "gender", "birthday",
    "deathday", "place_of_birth", "known_for_dept", "biography", "known_movies",
    "known_movie_ids", "directed_movies", "directed_movie_ids", "known_tv_shows",
    "known_tv_ids", "profile_url", "homepage",
)
PEOPLE_INT = ("total_movie_credits", "total_directed", "total_tv_credits")
PEOPLE_DOUBLE = ("popularity",)

REVIEW_TEXT = ("review_id", "author", "content", "created_at", "url", "media_type")

# Dedupe order columns, rating range and popularity cuts.
MOVIE_ORDER = ("release_year", "vote_count", "popularity")
PEOPLE_ORDER = ("popularity", "total_movie_credits")
RATING_RANGE = (0, 10)
POPULARITY_CUTS = (300, 100)


def movie_typed(raw: DataFrame) -> DataFrame:
    """T1 value rules: typed, negative money -> null. Every row stays."""
    df = typed(raw, text=MOVIE_TEXT, ids=TITLE_IDS, ints=MOVIE_INT, doubles=MOVIE_DOUBLE, bools=MOVIE_BOOL, lists=("genres",))
    return df.withColumns({c: not_negative(F.col(c))
                           for c in ("budget_usd", "revenue_usd") if c in df.columns})


def movie_rows(raw: DataFrame) -> DataFrame:
    """T1 row-level part: the value rules and valid ids (no shuffle)."""
    return movie_typed(raw).where(valid_id())


def clean_movies(raw: DataFrame, ties: str | None = "*") -> DataFrame:
    """``movie_rows`` then one row per ``tmdb_id``."""
    return best_per_key(movie_rows(raw), "tmdb_id", *MOVIE_ORDER, ties=ties)


def tv_typed(raw: DataFrame) -> DataFrame:
    return typed(raw, text=TV_TEXT, ids=TITLE_IDS, ints=TV_INT, doubles=TV_DOUBLE, bools=TV_BOOL, lists=("genres",))


def tv_rows(raw: DataFrame) -> DataFrame:
    """T2 row-level part."""
    return tv_typed(raw).where(valid_id())


def with_bucket(tv: DataFrame) -> DataFrame:
    return tv.withColumn("popularity_bucket", three_way(F.col("popularity"), *POPULARITY_CUTS))


def clean_tv(raw: DataFrame, ties: str | None = "*") -> DataFrame:
    """Like T1 plus the three-way popularity bucket (computed after dedupe)."""
    return with_bucket(best_per_key(tv_rows(raw), "tmdb_id", *MOVIE_ORDER, ties=ties))


def people_typed(raw: DataFrame) -> DataFrame:
    return typed(raw, text=PEOPLE_TEXT, ids=("tmdb_id",), ints=PEOPLE_INT, doubles=PEOPLE_DOUBLE)


def people_rows(raw: DataFrame) -> DataFrame:
    """T3 row-level part."""
    return people_typed(raw).where(valid_id())


def clean_people(raw: DataFrame, ties: str | None = "*") -> DataFrame:
    """T3."""
    return best_per_key(people_rows(raw), "tmdb_id", *PEOPLE_ORDER, ties=ties)


def review_typed(raw: DataFrame) -> DataFrame:
    df = typed(raw, text=REVIEW_TEXT, ids=("tmdb_id",), doubles=("rating",))
    return df.withColumn("rating", within(F.col("rating"), *RATING_RANGE))


def review_rows(raw: DataFrame) -> DataFrame:
    """T4 row-level part."""
    return review_typed(raw).where(has_text("review_id"))


def rate_typed(raw: DataFrame) -> DataFrame:
    df = typed(raw, text=("currency",), doubles=("rate",))
    return df.withColumn("currency", clean_code(F.col("currency")))


def rate_rows(raw: DataFrame) -> DataFrame:
    """T5 row-level part."""
    return rate_typed(raw).where("currency IS NOT NULL AND rate > 0")


# Row-level cleaner, key and dedupe order per table (used by the incremental mode).
ROW_CLEANERS = {
    "movies": (movie_rows, "tmdb_id", MOVIE_ORDER),
    "tv_shows": (tv_rows, "tmdb_id", MOVIE_ORDER),
    "people": (people_rows, "tmdb_id", PEOPLE_ORDER),
    "movie_reviews": (review_rows, "review_id", ("created_at",)),
    "exchange": (rate_rows, "currency", ("rate",)),
}


def one_per_key(rows: DataFrame, name: str) -> DataFrame:
    """W1 over the cleaned rows of a lake table."""
    _, key, order = ROW_CLEANERS[name]
    return best_per_key(rows, key, *order, ties="*")


def clean_reviews(raw: DataFrame, known_titles: DataFrame | None = None,
                  ties: str | None = "*") -> DataFrame:
    """T4: typed, rating outside [0, 10] -> null, non-empty id, newest ``created_at``
    (string order, as in the reference) per review, only reviews of known titles
    (left-semi join, J6)."""
    df = best_per_key(review_rows(raw), "review_id", "created_at", ties=ties)
    if known_titles is not None:
        df = keep_known(df, known_titles, "tmdb_id")
    return df


def clean_exchange(raw: DataFrame, mode: str = "highest", landed: str = "run_ts") -> DataFrame:
    """T5: one rate per upper-cased currency.

    ``mode="highest"`` keeps the highest rate ever landed (reference, B4);
    ``mode="latest"`` keeps the rate of the newest landing (column ``landed``, e.g.
    the ``run_ts`` partition of the raw zone), highest rate among equal landings."""
    df = rate_rows(raw)
    if mode == "highest":
        return best_per_key(df, "currency", "rate", ties="*")
    if mode == "latest":
        return best_per_key(df, "currency", landed, "rate", ties="*")
    raise ValueError("mode must be 'highest' or 'latest'")


def genre_bridge(movies: DataFrame, distinct: bool = False) -> DataFrame:
    """``(tmdb_id, genre)`` rows from the normalised genre list."""
    return bridge(movies, "tmdb_id", "genres", "genre", distinct=distinct)


def trusted_tables(raw: dict[str, DataFrame], code: str = "COP", fx_mode: str = "highest",
                   on_missing: str = "identity") -> dict[str, DataFrame]:
    """T1-T7 as lazy plans (no writes). ``raw`` maps table name -> raw string frame."""
    exchange = clean_exchange(raw["exchange"], mode=fx_mode)
    movies = financial_metrics(clean_movies(raw["movies"]), exchange, code, on_missing=on_missing)
    out = {
        "movies": movies,
        "movie_genres": genre_bridge(movies),
        "people": clean_people(raw["people"]),
        "movie_reviews": clean_reviews(raw["movie_reviews"], movies),
        "exchange": exchange,
    }
    if "tv_shows" in raw:
        out["tv_shows"] = clean_tv(raw["tv_shows"])
    return out


def raw_to_trusted(spark: SparkSession, raw_prefix: str, trusted_prefix: str,
                   code: str = "COP", fx_mode: str = "highest",
                   on_missing: str = "identity", header_safe: bool = True,
                   buckets: int | None = None, quarantine: bool = False) -> dict[str, int]:
    """The full job. Returns row counts per written table and the raw rows rejected for
    their id (from write-time observations, not extra count jobs). The six tables are published
    together as one version of the zone: readers see all old or all new ones. ``header_safe`` reads each raw dataset
    grouped by file header (U2) instead of trusting the first file's column order.
    ``buckets`` writes movies, movie_genres and movie_reviews bucketed alike on
    ``tmdb_id`` so the curated joins on that key are co-located (no shuffle).
    ``quarantine`` keeps the refused raw rows with their reasons as a seventh table,
    ``rejected_rows`` (``plans.quarantine``)."""
    from trilake.session import size_shuffle_for
    from trilake.sources.raw_csv import read_raw, read_raw_by_header
    from trilake.sources.versions import Zone

    names = ("movies", "tv_shows", "people", "movie_reviews", "exchange")
    reader = read_raw_by_header if header_safe else read_raw
    raw = {n: reader(spark, f"{raw_prefix.rstrip('/')}/{n}") for n in names}
    size_shuffle_for(spark, *raw.values())
    by = {"bucket_by": "tmdb_id", "buckets": buckets} if buckets else {}
    out = Zone(spark, trusted_prefix).draft()
    counts = {}
    if quarantine:
        from trilake.plans.quarantine import stage
        rows, refused = stage(spark, raw)
        counts["rejected_rows"] = out.write(refused, "rejected_rows", partition_by=["table_name"])
    else:
        rejected = {n: Observation(f"rejected_{n}") for n in ("movies", "tv_shows", "people")}
        for n, seen in rejected.items():  # counted during the write itself
            raw[n] = raw[n].observe(seen, F.count_if(~F.coalesce(identifier(F.col("tmdb_id")) > 0, F.lit(False))).alias("rows"))
        rows = {n: ROW_CLEANERS[n][0](raw[n]) for n in names}
    newest = (["run_ts"] if fx_mode == "latest" else []) + ["rate"]
    if fx_mode not in ("highest", "latest"):
        raise ValueError("mode must be 'highest' or 'latest'")
    counts["exchange"] = out.write(best_per_key(rows["exchange"], "currency", *newest, ties="*"), "exchange")
    movies = financial_metrics(one_per_key(rows["movies"], "movies"), out.table("exchange"), code, on_missing=on_missing)
    counts["movies"] = out.write(movies, "movies", **by)
    movies = out.table("movies")  # cut lineage: reuse the written table
    counts["movie_genres"] = out.write(genre_bridge(movies), "movie_genres", **by)
    counts["tv_shows"] = out.write(with_bucket(one_per_key(rows["tv_shows"], "tv_shows")), "tv_shows")
    counts["people"] = out.write(one_per_key(rows["people"], "people"), "people")
    reviews = keep_known(one_per_key(rows["movie_reviews"], "movie_reviews"), movies, "tmdb_id")
    counts["movie_reviews"] = out.write(reviews, "movie_reviews", **by)
    out.publish()
    return counts if quarantine else counts | {f"{n}_rejected": int(seen.get["rows"]) for n, seen in rejected.items()}
