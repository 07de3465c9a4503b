"""Contract queries of whole jobs and of dirty raw text.

``dirty_*``: raw-text look-alikes in which every cleaning rule meets what it is there for
(null-like text, ``1995.0``, exponents, negatives, ids above 32 bits, zero and missing ids,
blank and repeated tokens, several currencies, early years, duplicate ids with ties), made
from the given tables by key arithmetic. ``*_job``: the lake's jobs over landed CSV.

The oracles build the same rows in DuckDB and state the rules on their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilake.operators.multivalue import bridge, id_rows
from trilake.plans import lookalike as LA
from trilake.plans.trusted import clean_exchange, clean_movies, clean_people, clean_reviews, clean_tv

#: Added to the ids of dirty titles: above 32 bits.
BIG = 5_000_000_000


def _pick(key: str, n: int, values: dict[int, str], other: str):
    """SQL text: a value by key modulo n. The same in both engines."""
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in values.items())
    return f"CASE {key} % {n} {cases} ELSE {other} END"


def _dirty_title_columns(text: str) -> dict[str, str]:
    """SQL of the raw text columns; ``text`` is the engine's string type name."""
    k, year = "o_orderkey", "year(o_orderdate)"
    s = lambda e: f"CAST({e} AS {text})"
    return {
        # four orders share a title id; some ids are missing, zero, negative, decimal or no number
        "tmdb_id": _pick(k, 97, {0: "'0'", 1: "NULL", 2: "'-5'", 3: "'abc'", 4: "'1e3'", 5: "''"},
                         f"concat({_pick(k, 2, {0: repr(' ')}, repr(''))}, {s(f'{BIG} + {k} - {k} % 4')}, {_pick(k, 3, {0: repr('.0')}, repr(''))})"),
        "title": _pick(k, 11, {0: "' N/A '", 1: "'null'", 2: "'  '", 3: "'Null'"}, f"concat(' Title ', {s(k)}, ' ')"),
        "release_year": _pick(k, 13, {0: "'1e3'", 1: "'nan'", 2: "' 1975 '", 3: "'99999999999'"}, f"concat({s(year)}, '.0')"),
        "vote_count": _pick(k, 7, {0: "NULL", 1: "'x'", 2: "'-3.9'", 3: "'.5'"}, "'10'"),
        "popularity": _pick(k, 5, {0: "'NaN'", 1: "'1e2'", 2: "'junk'"}, "'7.25'"),
        "revenue_usd": _pick(k, 9, {0: "'-1'", 1: "'None'", 2: "'0'"}, s("CAST(o_totalprice AS DECIMAL(18,2))")),
        "budget_usd": _pick(k, 8, {0: "'-0.01'", 1: "'0'", 2: "''"}, "'1000.5'"),
        "has_trailer": _pick(k, 6, {0: "' YES '", 1: "'0'", 2: "'maybe'", 3: "NULL"}, "'True'"),
        "genres": _pick(k, 10, {0: "'Drama ,Comedy'", 1: "'a,,b'", 2: "'N/A'", 3: "',x,'", 4: "'War,war, WAR'", 5: "' '"}, "'Action, Drama'"),
        "cast_ids": _pick(k, 4, {0: f"concat('7, ', {s(f'{BIG} + {k}')}, ',x,,7.0')", 1: "' '"}, s(k)),
    }


_TITLE_OUT = ("tmdb_id", "title", "release_year", "vote_count", "popularity", "revenue_usd", "budget_usd", "has_trailer", "genres")


def dirty_titles(spark: SparkSession, d: str) -> DataFrame:
    return LA.table(spark, d, "orders").select(*[F.expr(e).alias(c) for c, e in _dirty_title_columns("STRING").items()])


def _duck_text(c: str) -> str:
    return f"CASE WHEN trim({c}, ' ') IN ('', 'null', 'NULL', 'None', 'nan', 'NaN', 'N/A', 'n/a') THEN NULL ELSE trim({c}, ' ') END"


def _duck_whole(c: str, kind: str) -> str:
    return (f"CASE WHEN regexp_matches(trim({c}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') "
            f"THEN TRY_CAST(trunc(TRY_CAST(trim({c}) AS DECIMAL(38,10))) AS {kind}) END")


def _duck_real(c: str) -> str:
    return f"CASE WHEN isnan(TRY_CAST(trim({c}) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim({c}) AS DOUBLE) END"


def _duck_list(c: str) -> str:
    g = f"regexp_replace(regexp_replace(lower(trim({c})), '\\s*,\\s*', ', ', 'g'), ',\\s*,', ', ', 'g')"
    return f"CASE WHEN {g} IN ('', 'null', 'NULL', 'None', 'nan', 'NaN', 'N/A', 'n/a') THEN NULL ELSE {g} END"


_DIRTY_TITLES = f"""
raw AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _dirty_title_columns('VARCHAR').items())} FROM orders),
known AS (SELECT {', '.join(f'{_duck_text(c)} AS {c}' if c in ('title', 'genres', 'cast_ids') else c for c in _dirty_title_columns('VARCHAR'))} FROM raw),
dirty AS (
  SELECT {_duck_whole('tmdb_id', 'BIGINT')} AS tmdb_id, title, {_duck_whole('release_year', 'INTEGER')} AS release_year,
         {_duck_whole('vote_count', 'INTEGER')} AS vote_count, {_duck_real('popularity')} AS popularity,
         CASE WHEN {_duck_real('revenue_usd')} >= 0 THEN {_duck_real('revenue_usd')} END AS revenue_usd,
         CASE WHEN {_duck_real('budget_usd')} >= 0 THEN {_duck_real('budget_usd')} END AS budget_usd,
         CASE WHEN lower(trim(has_trailer)) IN ('true', '1', 'yes') THEN TRUE
              WHEN lower(trim(has_trailer)) IN ('false', '0', 'no') THEN FALSE END AS has_trailer,
         {_duck_list('genres')} AS genres, cast_ids
  FROM known),
best AS (
  SELECT * FROM dirty WHERE tmdb_id > 0
  QUALIFY row_number() OVER (PARTITION BY tmdb_id ORDER BY release_year DESC NULLS LAST, vote_count DESC NULLS LAST,
          popularity DESC NULLS LAST, budget_usd DESC NULLS LAST, cast_ids DESC NULLS LAST, genres DESC NULLS LAST,
          has_trailer DESC NULLS LAST, revenue_usd DESC NULLS LAST, title DESC NULLS LAST) = 1)"""


def q_dirty_titles_clean(spark, d):
    """T1 on dirty text: P1-P6, F1, W1 with ties; 64-bit ids."""
    return clean_movies(dirty_titles(spark, d)).select(*_TITLE_OUT)


def q_dirty_titles_bridge(spark, d):
    """T7/M2 on dirty lists: blank and repeated tokens."""
    return bridge(clean_movies(dirty_titles(spark, d)), "tmdb_id", "genres", "genre")


def q_dirty_title_cast(spark, d):
    """M4 on dirty id lists: several ids, junk, blanks, decimals, ids above 32 bits."""
    return id_rows(clean_movies(dirty_titles(spark, d)), "cast_ids", "person", keep=["tmdb_id"])


def q_dirty_titles_finance(spark, d):
    """P10-P13 with stale derived columns in the input and missing or zero budgets; years
    below 1980 and small years meet D3's bounds (F7, F8)."""
    from trilake.operators.finance import add_profit_roi
    from trilake.plans.questions import revenue_by_year
    stale = clean_movies(dirty_titles(spark, d)).withColumns({"profit_usd": F.lit(-1.0), "roi_pct": F.lit("old")})
    t = add_profit_roi(stale).withColumn("revenue_cop", F.col("revenue_usd") * 2)
    return revenue_by_year(t, decade_from=1993, min_titles=3).select(
        "release_year", "n_movies", F.round("revenue_usd_total").alias("revenue_usd_total"), F.round("avg_roi_pct", 1).alias("avg_roi_pct"))


def dirty_people(spark, d):
    return LA.table(spark, d, "customer").select(
        F.expr(_pick("c_custkey", 19, {0: "'0'", 1: "NULL"}, f"CAST({BIG} + c_custkey - c_custkey % 2 AS STRING)")).alias("tmdb_id"),
        F.col("c_name").alias("name"), F.expr(_pick("c_custkey", 3, {0: "'5'", 1: "'n/a'"}, "'5.0'")).alias("popularity"),
        F.expr(_pick("c_custkey", 4, {0: "'1'"}, "'12.7'")).alias("total_movie_credits"))


def q_dirty_people_clean(spark, d):
    """T3 on dirty text."""
    return clean_people(dirty_people(spark, d)).select("tmdb_id", "name", "popularity", "total_movie_credits")


_DIRTY_PEOPLE = f"""
raw AS (SELECT {_pick('c_custkey', 19, {0: "'0'", 1: 'NULL'}, f'CAST({BIG} + c_custkey - c_custkey % 2 AS VARCHAR)')} AS tmdb_id, c_name AS name,
               {_pick('c_custkey', 3, {0: "'5'", 1: "'n/a'"}, "'5.0'")} AS popularity,
               {_pick('c_custkey', 4, {0: "'1'"}, "'12.7'")} AS total_movie_credits FROM customer)
SELECT {_duck_whole('tmdb_id', 'BIGINT')} AS tmdb_id, name, {_duck_real('popularity')} AS popularity,
       {_duck_whole('total_movie_credits', 'INTEGER')} AS total_movie_credits
FROM raw WHERE {_duck_whole('tmdb_id', 'BIGINT')} > 0
QUALIFY row_number() OVER (PARTITION BY {_duck_whole('tmdb_id', 'BIGINT')} ORDER BY {_duck_real('popularity')} DESC NULLS LAST,
        {_duck_whole('total_movie_credits', 'INTEGER')} DESC NULLS LAST, name DESC NULLS LAST) = 1"""


def dirty_shows(spark, d):
    return LA.table(spark, d, "part").select(
        F.expr(f"CAST({BIG} + p_partkey AS STRING)").alias("tmdb_id"), F.col("p_name").alias("title"),
        F.expr(_pick("p_partkey", 5, {0: "NULL", 1: "'300'", 2: "'300.5'", 3: "'100.5'"}, "'-1'")).alias("popularity"),
        F.expr(_pick("p_partkey", 4, {0: "'no'", 1: "'1'", 2: "'perhaps'"}, "NULL")).alias("in_production"))


def q_dirty_shows_clean(spark, d):
    """T2 on dirty text: the bucket of missing and edge values, every spelling of P4."""
    return clean_tv(dirty_shows(spark, d)).select("tmdb_id", "title", "popularity", "in_production", "popularity_bucket")


_DIRTY_SHOWS = f"""
SELECT CAST({BIG} + p_partkey AS BIGINT) AS tmdb_id, trim(p_name, ' ') AS title, p AS popularity,
       CASE p_partkey % 4 WHEN 0 THEN FALSE WHEN 1 THEN TRUE END AS in_production,
       CASE WHEN p > 300 THEN 'high' WHEN p > 100 THEN 'medium' ELSE 'low' END AS popularity_bucket
FROM (SELECT *, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 300.0::DOUBLE WHEN 2 THEN 300.5 WHEN 3 THEN 100.5 ELSE -1 END AS p FROM part) t"""


def dirty_reviews(spark, d):
    """Ids above 32 bits, empty and repeated review ids, ratings outside the range."""
    return LA.table(spark, d, "events").select(
        F.expr(_pick("event_id", 17, {0: "''", 1: "'null'", 2: "NULL"}, "CAST(event_id - event_id % 3 AS STRING)")).alias("review_id"),
        F.expr(f"CAST({BIG} + user_id % 50 AS STRING)").alias("tmdb_id"),
        F.expr(_pick("event_id", 7, {0: "'11'", 1: "'-0.5'", 2: "'10'", 3: "'none'"}, "CAST(event_id % 10 AS STRING)")).alias("rating"),
        F.expr("CAST(event_id % 5 AS STRING)").alias("created_at"), F.expr("CAST(event_id AS STRING)").alias("author"))


def q_dirty_reviews_clean(spark, d):
    """T4 on dirty text with the known-title rule."""
    titles = spark.range(BIG, BIG + 40).select(F.col("id").alias("tmdb_id"))
    return clean_reviews(dirty_reviews(spark, d), titles).select("review_id", "tmdb_id", "rating", "author")


_DIRTY_REVIEWS = f"""
SELECT review_id, created_at, tmdb_id, CASE WHEN r BETWEEN 0 AND 10 THEN r END AS rating, author
FROM (SELECT CASE WHEN event_id % 17 IN (0, 1, 2) THEN NULL ELSE CAST(event_id - event_id % 3 AS VARCHAR) END AS review_id,
             CAST({BIG} + user_id % 50 AS BIGINT) AS tmdb_id,
             CASE event_id % 7 WHEN 0 THEN 11 WHEN 1 THEN -0.5 WHEN 2 THEN 10 WHEN 3 THEN NULL ELSE event_id % 10 END::DOUBLE AS r,
             CAST(event_id % 5 AS VARCHAR) AS created_at, CAST(event_id AS VARCHAR) AS author FROM events) t
WHERE review_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY created_at DESC NULLS LAST, author DESC, rating DESC NULLS LAST, tmdb_id DESC) = 1
    AND TRUE"""


def dirty_rates(spark, d):
    return LA.table(spark, d, "orders").select(
        F.expr(_pick("o_orderkey", 6, {0: "' cop'", 1: "'COP '", 2: "'usd'", 3: "'N/A'", 4: "'Eur'"}, "'JPY'")).alias("currency"),
        F.expr(_pick("o_orderkey", 5, {0: "'-4'", 1: "'0'", 2: "'nan'"}, "CAST(o_orderkey % 1000 AS STRING)")).alias("rate"))


def q_dirty_rates_clean(spark, d):
    """T5 on dirty text: several currencies, rejected rates (F3), code rule."""
    return clean_exchange(dirty_rates(spark, d)).select("currency", "rate")


_DIRTY_RATES = """
SELECT currency, max(rate) AS rate FROM (
  SELECT CASE o_orderkey % 6 WHEN 0 THEN 'COP' WHEN 1 THEN 'COP' WHEN 2 THEN 'USD' WHEN 3 THEN NULL WHEN 4 THEN 'EUR' ELSE 'JPY' END AS currency,
         CASE WHEN o_orderkey % 5 IN (0, 1, 2) THEN NULL ELSE CAST(o_orderkey % 1000 AS DOUBLE) END AS rate FROM orders) t
WHERE currency IS NOT NULL AND rate > 0 GROUP BY currency"""


def q_rejected_rows(spark, d):
    """Refused rows of dirty titles, reviews and rates: how many rows each reason has, and a
    print of their raw keys."""
    from trilake.plans.quarantine import rejected_rows
    parts = [(dirty_titles(spark, d), "movies", "tmdb_id"), (dirty_reviews(spark, d), "movie_reviews", "author"), (dirty_rates(spark, d), "exchange", "rate")]
    out = None
    for raw, table, key in parts:
        part = rejected_rows(raw, table).withColumn("key", F.get_json_object("record", f"$.{key}"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n"), F.expr(_print("spark", "key")).alias("keys"))


def _oracle_rejected() -> str:
    k = "o_orderkey"
    rate = _pick(k, 5, {0: "'-4'", 1: "'0'", 2: "'nan'"}, f"CAST({k} % 1000 AS VARCHAR)")
    return f"""
SELECT table_name, reason, count(*) AS n, {_print('duckdb', 'key')} AS keys FROM (
  SELECT 'movies' AS table_name, CASE {k} % 97 WHEN 0 THEN 'tmdb_id is not positive' WHEN 1 THEN 'tmdb_id is missing' WHEN 2 THEN 'tmdb_id is not positive'
         WHEN 3 THEN 'tmdb_id is no number' WHEN 4 THEN 'tmdb_id is no number' WHEN 5 THEN 'tmdb_id is missing' END AS reason,
         CASE {k} % 97 WHEN 0 THEN '0' WHEN 2 THEN '-5' WHEN 3 THEN 'abc' WHEN 4 THEN '1e3' WHEN 5 THEN '' END AS key FROM orders
  UNION ALL SELECT 'movie_reviews', CASE WHEN event_id % 17 IN (0, 1, 2) THEN 'review_id is missing' END, CAST(event_id AS VARCHAR) FROM events
  UNION ALL SELECT 'exchange', CASE WHEN {k} % 6 = 3 THEN 'currency is missing' WHEN {k} % 5 = 2 THEN 'rate is missing'
         WHEN {k} % 5 IN (0, 1) OR {k} % 1000 = 0 THEN 'rate is not positive' END, {rate} FROM orders) t
WHERE reason IS NOT NULL GROUP BY table_name, reason"""


# ------------------------------------------------------------------ jobs


def _landed(spark: SparkSession, d: str, root: str) -> None:
    from trilake.sources.raw_csv import ingest_all
    c = LA.table(spark, d, "customer")
    ingest_all({
        "movies": LA.base_titles(spark, d),
        "tv_shows": c.select(F.col("c_custkey").alias("tmdb_id"), F.col("c_name").alias("title"),
                             (F.col("c_acctbal") / F.lit(20.0)).alias("popularity")),
        "people": LA.table(spark, d, "supplier").select(F.col("s_suppkey").alias("tmdb_id"), F.col("s_name").alias("name")),
        "movie_reviews": LA.raw_reviews(spark, d),
        "exchange": LA.raw_rates(spark, d),
    }, f"{root}/raw", run_ts="20240101_000000")


def _facts(tables: dict[str, tuple[DataFrame, str, dict[str, str]]]) -> DataFrame:
    """(table_name, row_key, measure, value) rows of several tables."""
    out = None
    for name, (df, key, measures) in tables.items():
        pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(e).cast("double").alias("value")) for m, e in measures.items()])
        rows = df.select(F.lit(name).alias("table_name"), F.expr(key).cast("string").alias("row_key"), F.inline(pairs))
        out = rows if out is None else out.unionByName(rows)
    return out


def _print(engine: str, *columns: str) -> str:
    """SQL text: the sum of a 32-bit print of every row's columns as text, the same in both
    engines: one differing character in one row shows."""
    text = f"concat_ws('|', {', '.join(columns)})"
    if engine == "spark":
        return f"sum(CAST(conv(substr(md5({text}), 1, 8), 16, 10) AS BIGINT))"
    return f"sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT))"


def _units(column: str, per: int) -> str:
    """SQL text: the sum of a measure in whole units of 1/per, and of its known rows."""
    return f"sum(CAST(floor(CAST({column} AS DOUBLE) * {per} + 0.25) AS BIGINT))"


def _trusted_facts(engine: str) -> dict[str, dict[str, str]]:
    """Per trusted table: sums that show every row and column of it."""
    text = lambda *c: _print(engine, *c)
    money = {m: _units(m, 100) for m in ("revenue_usd", "budget_usd", "profit_usd")}
    return {
        "movies": {"n": "count(*)", "rows": text("tmdb_id", "title", "release_year", "vote_count", "cast_ids", "genres", "directors"),
                   "known_profit": "count(profit_usd)", "known_roi": "count(roi_pct)", "rating": _units("vote_average", 100), **money,
                   "roi": _units("roi_pct", 1000), "cop": _units("revenue_cop", 10)},
        "movie_genres": {"n": "count(*)", "rows": text("tmdb_id", "genre")},
        "people": {"n": "count(*)", "rows": text("tmdb_id", "name")},
        "tv_shows": {"n": "count(*)", "rows": text("tmdb_id", "title", "popularity_bucket"), "popularity": _units("popularity", 100)},
        "movie_reviews": {"n": "count(*)", "rows": text("review_id", "tmdb_id", "author"), "rated": "count(rating)", "ratings": _units("rating", 1000)},
        "exchange": {"n": "count(*)", "rows": text("currency"), "rates": _units("rate", 100)},
    }


def q_lake_job_tables(spark, d):
    """All six trusted tables of the written job."""
    from trilake.plans.trusted import raw_to_trusted
    from trilake.session import shared_dir
    from trilake.sources.parquet import read_table
    root = shared_dir(spark, "lake_job", uuid.uuid4().hex)
    _landed(spark, d, root)
    raw_to_trusted(spark, f"{root}/raw", f"{root}/trusted", code=LA.FX_CODE)
    return _facts({name: (read_table(spark, f"{root}/trusted", name).agg(*[F.expr(e).alias(m) for m, e in facts.items()]), "'all'",
                          {m: m for m in facts}) for name, facts in _trusted_facts("spark").items()})


def _oracle_lake_tables() -> str:
    from trilake.contract import _with
    source = {
        "movies": "(SELECT * REPLACE (CAST(revenue_usd AS DOUBLE) * CAST((SELECT rate FROM fxrate) AS DOUBLE) AS revenue_cop) FROM titles WHERE tmdb_id > 0) t",
        "movie_genres": "(SELECT tmdb_id, trim(unnest(string_split(genres, ','))) AS genre FROM titles) WHERE genre <> ''",
        "people": "people_like",
        "tv_shows": """(SELECT c_custkey AS tmdb_id, c_name AS title, CAST(c_acctbal AS DOUBLE) / 20 AS popularity, CASE WHEN c_acctbal / 20.0 > 300 THEN 'high'
                        WHEN c_acctbal / 20.0 > 100 THEN 'medium' ELSE 'low' END AS popularity_bucket FROM customer WHERE c_custkey > 0)""",
        "movie_reviews": """(SELECT CAST(event_id AS VARCHAR) AS review_id, user_id * 100 + 1 AS tmdb_id, event_type AS author,
                             CASE WHEN value / 49.0 BETWEEN 0 AND 10 THEN value / 49.0 END AS rating FROM events
                             WHERE user_id * 100 + 1 IN (SELECT tmdb_id FROM titles))""",
        "exchange": "exchange_like",
    }
    parts = [f"SELECT '{t}' AS table_name, 'all' AS row_key, '{m}' AS measure, CAST({e} AS DOUBLE) AS value FROM {source[t]}"
             for t, facts in _trusted_facts("duckdb").items() for m, e in facts.items()]
    return _with("\nUNION ALL\n".join(parts))


def q_curated_job(spark, d):
    """D7 with S3 and S5: both jobs over landed CSV, then the six written curated tables (of
    the sample, what does not depend on which rows were drawn)."""
    from trilake.plans.curated import trusted_to_curated
    from trilake.plans.trusted import raw_to_trusted
    from trilake.session import shared_dir
    from trilake.sources.parquet import load_curated
    root = shared_dir(spark, "curated_job", uuid.uuid4().hex)
    _landed(spark, d, root)
    raw_to_trusted(spark, f"{root}/raw", f"{root}/trusted", code=LA.FX_CODE)
    trusted_to_curated(spark, f"{root}/trusted", f"{root}/curated", sample_mode="hash")
    t = {n: load_curated(spark, f"{root}/curated", n, cache=False) for n in
         ("revenue_by_genre", "top_actors_rentables", "revenue_by_year", "roi_by_director", "ratings_correlations", "ratings_vs_revenue_sample")}
    return _curated_facts(t)


#: Columns of the answers that are compared row by row, as they are written.
_ANSWERS = {
    "revenue_by_genre": ("genre", ("n_movies", "revenue_usd_total", "revenue_usd_avg", "revenue_cop_total", "revenue_cop_avg")),
    "top_actors_rentables": ("concat(actor_id, ' ', actor_name)", ("n_movies_rentables", "avg_profit_usd", "total_revenue_usd")),
    "revenue_by_year": ("release_year", ("n_movies", "revenue_usd_total", "revenue_cop_total", "avg_roi_pct")),
    "roi_by_director": ("director_name", ("n_movies", "avg_roi_pct", "avg_profit_usd", "total_revenue_usd")),
    "ratings_correlations": ("'all'", ("corr_tmdb_revenue", "corr_tmdb_profit", "corr_tmdb_roi", "corr_reviews_revenue",
                                       "corr_reviews_profit", "corr_reviews_roi")),
}


def _sample_facts(engine: str) -> dict[str, str]:
    """All columns of the sample, as sums over its rows."""
    return {"n": "count(*)", "rows": _print(engine, "tmdb_id", "title"), "rating": _units("vote_average", 100), "usd": _units("revenue_usd", 100),
            "profit": _units("profit_usd", 100), "reviews": _units("avg_review_rating", 100), "reviewed": "count(avg_review_rating)"}


def _curated_facts(t: dict[str, DataFrame]) -> DataFrame:
    tables = {n: (t[n], key, {c: c for c in columns}) for n, (key, columns) in _ANSWERS.items() if n in t}
    if "ratings_vs_revenue_sample" in t:
        facts = _sample_facts("spark")
        tables["ratings_vs_revenue_sample"] = (t["ratings_vs_revenue_sample"].agg(*[F.expr(e).alias(m) for m, e in facts.items()]), "'all'", {m: m for m in facts})
    return _facts(tables)


def _oracle_curated(names=(*_ANSWERS, "ratings_vs_revenue_sample")) -> str:
    from trilake.contract import _REVIEW_AGG, _with
    cop = "CAST(revenue_usd AS DOUBLE) * CAST((SELECT rate FROM fxrate) AS DOUBLE)"
    mean = lambda s, n: f"ROUND(CAST({s} AS DOUBLE) / NULLIF({n}, 0), 2)"
    coefficients = ", ".join(f"ROUND(CORR({x}, CAST({y} AS DOUBLE)), 4) AS corr_{a}_{b}" for a, x in (("tmdb", "vote_average"), ("reviews", "avg_review_rating"))
                             for b, y in (("revenue", "revenue_usd"), ("profit", "profit_usd"), ("roi", "roi_pct")))
    extra = _REVIEW_AGG + f""",
g AS (SELECT tmdb_id, revenue_usd, {cop} AS cop, trim(unnest(string_split(genres, ','))) AS genre FROM titles WHERE revenue_usd > 0 AND revenue_cop IS NOT NULL),
revenue_by_genre AS (SELECT genre, COUNT(DISTINCT tmdb_id) AS n_movies, ROUND(CAST(SUM(revenue_usd) AS DOUBLE), 2) AS revenue_usd_total,
    {mean('SUM(revenue_usd)', 'COUNT(*)')} AS revenue_usd_avg, ROUND(fsum(cop), 2) AS revenue_cop_total, ROUND(fsum(cop) / COUNT(*), 2) AS revenue_cop_avg
    FROM g WHERE genre <> '' GROUP BY genre),
top_actors_rentables AS (SELECT p.tmdb_id AS actor_id, p.name AS actor_name, COUNT(DISTINCT t.tmdb_id) AS n_movies_rentables,
    {mean('SUM(t.profit_usd)', 'COUNT(*)')} AS avg_profit_usd, ROUND(CAST(SUM(t.revenue_usd) AS DOUBLE), 2) AS total_revenue_usd
    FROM titles t JOIN people_like p ON CAST(t.cast_ids AS BIGINT) = p.tmdb_id WHERE t.profit_usd > 0 GROUP BY p.tmdb_id, p.name
    ORDER BY n_movies_rentables DESC, avg_profit_usd DESC, p.tmdb_id LIMIT 25),
revenue_by_year AS (SELECT release_year, COUNT(*) AS n_movies, ROUND(CAST(SUM(revenue_usd) AS DOUBLE), 2) AS revenue_usd_total,
    ROUND(fsum({cop}), 2) AS revenue_cop_total, ROUND(fsum(roi_pct) / NULLIF(COUNT(roi_pct), 0), 2) AS avg_roi_pct FROM titles
    WHERE release_year >= 1980 AND revenue_usd IS NOT NULL GROUP BY release_year HAVING COUNT(*) >= 5),
dd AS (SELECT tmdb_id, roi_pct, profit_usd, revenue_usd, trim(unnest(string_split(directors, ','))) AS director_name FROM titles WHERE roi_pct IS NOT NULL),
roi_by_director AS (SELECT director_name, COUNT(DISTINCT tmdb_id) AS n_movies, ROUND(fsum(roi_pct) / COUNT(*), 2) AS avg_roi_pct,
    {mean('SUM(profit_usd)', 'COUNT(profit_usd)')} AS avg_profit_usd, ROUND(CAST(SUM(revenue_usd) AS DOUBLE), 2) AS total_revenue_usd
    FROM dd WHERE director_name <> '' GROUP BY director_name HAVING COUNT(DISTINCT tmdb_id) >= 3 ORDER BY avg_roi_pct DESC, director_name LIMIT 20),
rated AS (SELECT t.*, ra.avg_review_rating FROM titles t LEFT JOIN ra ON t.tmdb_id = ra.tmdb_id WHERE revenue_usd > 0 AND vote_average IS NOT NULL),
ratings_correlations AS (SELECT {coefficients} FROM rated),
sample AS (SELECT * REPLACE (ROUND(avg_review_rating, 2) AS avg_review_rating) FROM rated ORDER BY md5('42:' || CAST(tmdb_id AS VARCHAR)), tmdb_id LIMIT 2000),
ratings_vs_revenue_sample AS (SELECT {', '.join(f'{e} AS "{m}"' for m, e in _sample_facts('duckdb').items())} FROM sample)"""
    answers = _ANSWERS | {"ratings_vs_revenue_sample": ("'all'", tuple(_sample_facts("duckdb")))}
    parts = [f"""SELECT '{t}' AS table_name, CAST({answers[t][0]} AS VARCHAR) AS row_key, '{m}' AS measure, CAST("{m}" AS DOUBLE) AS value FROM {t}"""
             for t in names for m in answers[t][1]]
    return _with("\nUNION ALL\n".join(parts), extra)


def q_incremental_answers(spark, d):
    """ST1 with D7: titles, reviews and rates landed in two runs each; after each run the
    keyed tables are merged and D1, D3 and D5 follow by what changed."""
    from trilake.contract import kept
    from trilake.plans.delta import MaintainedAnswers
    from trilake.session import shared_dir
    from trilake.sources.raw_csv import land_raw
    from trilake.streaming.incremental import incremental_trusted, lake_table
    base = shared_dir(spark, "incremental_answers", uuid.uuid4().hex)
    raw = {"movies": kept(LA.base_titles(spark, d), "incremental_answers"), "movie_reviews": LA.raw_reviews(spark, d), "exchange": LA.raw_rates(spark, d)}
    tables = {n: lake_table(spark, n, f"{base}/{n}/current", 16) for n in raw}
    answers = MaintainedAnswers(spark, f"{base}/answers", tables["movies"], tables["movie_reviews"], tables["exchange"], LA.FX_CODE)
    for i in (0, 1):
        for name, df in raw.items():
            # the rates land whole at first: another rate would build the answers anew
            part = F.lit(i == 0) if name == "exchange" else F.pmod(F.xxhash64(*df.columns), F.lit(2)) == i
            land_raw(df.where(part), f"{base}/raw", name, run_ts=f"run{i}")
            incremental_trusted(spark, f"{base}/raw/{name}", name, f"{base}/{name}/current", f"{base}/{name}/ckpt", buckets=16)
        answers.update()
    return _curated_facts({"revenue_by_genre": answers.revenue_by_genre(), "revenue_by_year": answers.revenue_by_year(),
                           "ratings_correlations": answers.ratings_correlations()})


def _incremental(spark, d, name: str, raw: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows landed in two runs whose files differ in column order, each processed by ST1."""
    from trilake.session import shared_dir
    from trilake.sources.raw_csv import land_raw
    from trilake.streaming.incremental import incremental_trusted
    base = shared_dir(spark, f"incremental_{name}", uuid.uuid4().hex)
    half = F.pmod(F.xxhash64(*raw.columns), F.lit(2))
    out = None
    for i in (0, 1):
        order = raw.columns if i == 0 else raw.columns[::-1]
        land_raw(raw.where(half == i).select(*order), f"{base}/raw", name, run_ts=f"run{i}")
        out = incremental_trusted(spark, f"{base}/raw/{name}", name, f"{base}/changes", f"{base}/ckpt")
    return out.select(*columns)


def q_incremental_reordered(spark, d):
    """ST1 over dirty titles in two landings with other column orders. Ties go to the
    landing first, so only what the order columns settle is returned."""
    return _incremental(spark, d, "movies", dirty_titles(spark, d), ("tmdb_id", "release_year", "vote_count", "popularity"))


def q_incremental_reviews(spark, d):
    """ST1 for reviews, with the winner's columns: the newest ``created_at`` settles it."""
    return _incremental(spark, d, "movie_reviews", dirty_reviews(spark, d), ("review_id", "created_at", "tmdb_id", "rating", "author"))


def q_incremental_exchange(spark, d):
    """ST1 for rates."""
    return _incremental(spark, d, "exchange", dirty_rates(spark, d), ("currency", "rate"))


def q_bernoulli_sample(spark, d):
    """What holds for any Bernoulli sample of the titles: at most n rows, every row in
    the base, no row twice, and a size within six standard deviations of the expected."""
    from trilake.operators.sample import sample_n
    n = 2000
    base = LA.stored(spark, d, "movies").where("revenue_usd > 0 AND vote_average IS NOT NULL").select("tmdb_id")
    total = base.agg(F.count(F.lit(1)).cast("double")).scalar()
    drawn = sample_n(base, n)
    known = LA.table(spark, d, "lineitem").select(LA.title_key().alias("tmdb_id")).distinct().withColumn("known", F.lit(1))
    share = F.least(F.lit(1.0), F.lit(1.2 * n) / total)
    spread = 6 * F.sqrt(total * share * (1 - share)) + 1
    return drawn.join(known, "tmdb_id", "left").agg(
        F.count(F.lit(1)).alias("c"), F.count_distinct("tmdb_id").alias("k"), F.count("known").alias("inside")).select(
        (F.col("c") <= n).alias("at_most_n"), (F.col("c") == F.col("k")).alias("no_repeats"), (F.col("c") == F.col("inside")).alias("all_known"),
        (F.col("c") >= F.least(F.lit(float(n)), total * share - spread)).alias("large_enough"))


def q_chart_feeds(spark, d):
    """K3: chart order, bar labels, the descending genre table and the three-column actor
    table, each row with its place."""
    from pyspark.sql import Window
    from trilake.plans import kpi, questions as Q
    t = LA.stored(spark, d, "movies")
    genres, actors, directors = Q.revenue_by_genre(t), Q.top_actors_rentables(t, LA.stored(spark, d, "people")), Q.roi_by_director(t)

    def placed(feed, name, by, label, text):
        place = F.row_number().over(Window.orderBy(*by))  # at most 25 rows, or one per genre
        return feed.select(F.lit(name).alias("feed"), place.alias("place"), F.col(label).cast("string").alias("label"), text.cast("string").alias("shown"))

    asc = lambda m, k: (F.col(m).asc(), F.col(k).desc())
    table = kpi.actor_table(actors)
    out = placed(kpi.genre_bars(genres), "genre_bars", asc("revenue_usd_total", "genre"), "genre", F.col("bar_label"))
    out = out.unionByName(placed(kpi.director_bars(directors), "director_bars", asc("avg_roi_pct", "director_name"), "director_name", F.col("bar_label")))
    out = out.unionByName(placed(kpi.chart_order(actors, "n_movies_rentables", "actor_name"), "actor_chart",
                                 asc("n_movies_rentables", "actor_name"), "actor_name", F.col("n_movies_rentables")))
    name, count = kpi.ACTOR_CAPTIONS["actor_name"], kpi.ACTOR_CAPTIONS["n_movies_rentables"]
    out = out.unionByName(placed(table, "actor_table", (F.col(f"`{count}`").desc(), F.col(f"`{name}`").asc()), name, F.lit(len(table.columns))))
    g = kpi.genre_table(genres)
    gname, gcount = kpi.GENRE_CAPTIONS["genre"], kpi.GENRE_CAPTIONS["n_movies"]
    total = kpi.GENRE_CAPTIONS["revenue_usd_total"]
    return out.unionByName(placed(g, "genre_table", (F.col(f"`{total}`").desc(), F.col(f"`{gname}`").asc()), gname, F.col(f"`{gcount}`")))


def _oracle_charts() -> str:
    from trilake.contract import _actor_oracle, _director_oracle, _genre_oracle
    genres = _genre_oracle("revenue_usd IS NOT NULL AND revenue_cop IS NOT NULL AND revenue_usd > 0",
                           {"n": "n_movies", "su": "revenue_usd_total", "au": "revenue_usd_avg", "sc": "revenue_cop_total", "ac": "revenue_cop_avg"})
    place = lambda by: f"CAST(row_number() OVER (ORDER BY {by}) AS INTEGER)"
    return f"""
SELECT 'genre_bars' AS feed, {place('revenue_usd_total, genre DESC')} AS place, genre AS label,
       '$' || format('{{:,.2f}}', revenue_usd_total / 1e9) || 'B' AS shown
FROM (SELECT * FROM ({genres}) a ORDER BY revenue_usd_total DESC, genre LIMIT 15) b
UNION ALL SELECT 'director_bars', {place('avg_roi_pct, director_name DESC')}, director_name, format('{{:,.1f}}', avg_roi_pct) || '%' FROM ({_director_oracle(False)}) c
UNION ALL SELECT 'actor_chart', {place('n_movies_rentables, actor_name DESC')}, actor_name, CAST(n_movies_rentables AS VARCHAR) FROM ({_actor_oracle(False)}) e
UNION ALL SELECT 'actor_table', {place('n_movies_rentables DESC, actor_name')}, actor_name, '3' FROM ({_actor_oracle(False)}) f
UNION ALL SELECT 'genre_table', {place('revenue_usd_total DESC, genre')}, genre, CAST(n_movies AS VARCHAR) FROM ({genres}) h"""


def queries() -> dict:
    return {f.__name__.removeprefix("q_"): f for f in (
        q_dirty_titles_clean, q_dirty_titles_bridge, q_dirty_title_cast, q_dirty_titles_finance, q_dirty_people_clean, q_dirty_shows_clean,
        q_dirty_reviews_clean, q_dirty_rates_clean, q_rejected_rows, q_lake_job_tables, q_curated_job, q_incremental_reordered, q_incremental_reviews,
        q_incremental_exchange, q_incremental_answers, q_bernoulli_sample, q_chart_feeds)}


def oracle_sql() -> dict:
    return {
        "dirty_titles_clean": f"WITH {_DIRTY_TITLES} SELECT {', '.join(_TITLE_OUT)} FROM best",
        "dirty_titles_bridge": f"WITH {_DIRTY_TITLES} SELECT tmdb_id, genre FROM (SELECT tmdb_id, trim(unnest(string_split(genres, ','))) AS genre "
                               "FROM best WHERE genres IS NOT NULL) t WHERE genre <> ''",
        "dirty_title_cast": f"WITH {_DIRTY_TITLES} SELECT tmdb_id, person FROM (SELECT tmdb_id, {_duck_whole('tok', 'BIGINT')} AS person "
                            "FROM (SELECT tmdb_id, unnest(string_split(cast_ids, ',')) AS tok FROM best WHERE cast_ids IS NOT NULL) a) b WHERE person IS NOT NULL",
        "dirty_titles_finance": f"""WITH {_DIRTY_TITLES}
SELECT release_year, COUNT(*) AS n_movies, ROUND(SUM(revenue_usd)) AS revenue_usd_total,
       ROUND(ROUND(AVG(CASE WHEN budget_usd > 0 THEN revenue_usd / budget_usd * 100 END), 2), 1) AS avg_roi_pct
FROM best WHERE release_year >= 1993 AND revenue_usd IS NOT NULL GROUP BY release_year HAVING COUNT(*) >= 3""",
        "dirty_people_clean": f"WITH {_DIRTY_PEOPLE.strip()}",
        "dirty_shows_clean": _DIRTY_SHOWS,
        "dirty_reviews_clean": f"SELECT review_id, tmdb_id, rating, author FROM ({_DIRTY_REVIEWS}) x WHERE tmdb_id < {BIG} + 40",
        "dirty_rates_clean": _DIRTY_RATES,
        "rejected_rows": _oracle_rejected(),
        "lake_job_tables": _oracle_lake_tables(),
        "curated_job": _oracle_curated(),
        "incremental_reordered": f"WITH {_DIRTY_TITLES} SELECT tmdb_id, release_year, vote_count, popularity FROM best",
        "incremental_reviews": _DIRTY_REVIEWS,
        "incremental_exchange": _DIRTY_RATES,
        "incremental_answers": _oracle_curated(("revenue_by_genre", "revenue_by_year", "ratings_correlations")),
        "bernoulli_sample": "SELECT TRUE AS at_most_n, TRUE AS no_repeats, TRUE AS all_known, TRUE AS large_enough",
        "chart_feeds": _oracle_charts(),
    }
