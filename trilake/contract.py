"""Contract queries: every operator of SURVEY §2 exercised on the driver's tables,
each paired with an independent DuckDB SQL oracle.

Spark side: the library's own functions over the look-alike trusted tables
(``plans.lookalike``). Oracle side: plain SQL over the raw driver tables, building
the same look-alikes in CTEs. Decimal outputs are cast to double on both sides.

Exactness: money is decimal, so totals are exact in both engines, and means are the exact
sum over the count, divided once in doubles.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from trilake.functions import clean as C
from trilake.operators.dedupe import best_per_key
from trilake.operators.finance import roi_local
from trilake.operators.joins import cross_scalar, dealt_alike, distinct_keys, keep_known
from trilake.plans import kpi, lookalike as LA, questions as Q, questions_sql as QS
from trilake.plans.trusted import clean_exchange, clean_movies, clean_tv, genre_bridge
from trilake.sources.views import SQL_TABLES, register_views

# ------------------------------------------------------------------ helpers


def to_double(df: DataFrame) -> DataFrame:
    """Cast decimal columns to double (the trusted/curated schema type)."""
    return df.select([F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                      else F.col(f.name) for f in df.schema.fields])


def kept(df: DataFrame, name: str) -> DataFrame:
    """A frame that several steps read, written once in the shared folder."""
    import uuid

    from trilake.session import shared_dir
    path = shared_dir(df.sparkSession, f"{name}_source", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sql(spark: SparkSession, d: str, text: Callable[[dict], str], joined: tuple[str, ...] = ()) -> DataFrame:
    """An SQL question over views of the stored trusted tables; only the views that its text
    names are registered. Large tables that it joins on ``tmdb_id`` (``joined``) are dealt
    alike beforehand."""
    import hashlib
    tag = hashlib.md5(d.rstrip("/").encode()).hexdigest()[:8]
    views = {n: f"lk_{tag}_{n}" for n in SQL_TABLES}
    question = text(views)
    used = [n for n, v in views.items() if re.search(rf"\b{v}\b", question)]
    tables = {n: LA.stored(spark, d, n) for n in used}
    if joined:
        tables |= zip(joined, dealt_alike("tmdb_id", *[tables[n] for n in joined]))
    register_views(tables, prefix=f"lk_{tag}_")
    return spark.sql(question)


def _mean(s: str, n: str, digits: int) -> str:
    """DuckDB text of a rounded mean: the exact decimal sum over the count, divided in doubles."""
    return f"ROUND(CAST({s} AS DOUBLE) / NULLIF({n}, 0), {digits})"


def duck_int(expr: str, kind: str = "INTEGER") -> str:
    """Whole numbers by the survey's rule (P2), written here on its own: edge characters up
    to 0x20 go, an optional sign and digits with an optional fraction are cut, else null."""
    s = f"regexp_replace({expr}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    return (f"CASE WHEN regexp_matches({s}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') "
            f"THEN TRY_CAST(trunc(TRY_CAST({s} AS DECIMAL(38,10))) AS {kind}) END")


# The oracles state their own values; none comes from the library.
_NULL_LIKE_SQL = "'', 'null', 'NULL', 'None', 'nan', 'NaN', 'N/A', 'n/a'"
_LINE_TIES_SQL = ("l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, "
                  "l_quantity DESC NULLS LAST, l_discount DESC NULLS LAST")

# Look-alike trusted tables in DuckDB (see plans/lookalike.py).
LOOKALIKE_CTES = f"""
lines AS (
  SELECT d.*, p.p_name, p.p_brand, p.p_type, p.p_retailprice
  FROM (SELECT l_orderkey * 100 + l_linenumber AS tmdb_id, *
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey * 100 + l_linenumber
                ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
                         {_LINE_TIES_SQL}) = 1) d
  JOIN part p ON d.l_partkey = p.p_partkey),
rates_raw AS (
  SELECT k AS currency, json_extract_string(props, '$."' || k || '"') AS rate_text,
         'USD' AS base, strftime(ts, '%Y-%m-%d') AS date
  FROM (SELECT props, ts, unnest(json_keys(props)) AS k FROM events)),
exchange_like AS (
  SELECT upper(trim(currency)) AS currency, CAST(MAX(TRY_CAST(trim(rate_text) AS DOUBLE)) AS DECIMAL(18,4)) AS rate
  FROM rates_raw
  WHERE trim(currency) NOT IN ({_NULL_LIKE_SQL}) AND TRY_CAST(trim(rate_text) AS DOUBLE) > 0
  GROUP BY upper(trim(currency))),
fxrate AS (SELECT rate FROM exchange_like WHERE currency = 'K' LIMIT 1),
titles AS (
  SELECT tmdb_id, title, release_year, revenue_usd, budget_usd, vote_average, vote_count,
         cast_ids, genres, directors,
         revenue_usd - budget_usd AS profit_usd,
         CASE WHEN budget_usd > 0
              THEN CAST(revenue_usd AS DOUBLE) / CAST(budget_usd AS DOUBLE) * 100 END AS roi_pct,
         revenue_usd * coalesce((SELECT rate FROM fxrate), 1) AS revenue_cop
  FROM (SELECT tmdb_id,
               'Title ' || CAST(tmdb_id AS VARCHAR) AS title,
               CAST(year(l_shipdate) AS INTEGER) AS release_year,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue_usd,
               CAST(CAST(l_quantity AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,2))
                   AS budget_usd,
               CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS DOUBLE) AS vote_average,
               CAST(l_quantity AS INTEGER) AS vote_count,
               CAST(l_suppkey AS VARCHAR) AS cast_ids,
               replace(p_name, ' ', ', ') AS genres,
               p_brand || ',' || p_type AS directors
        FROM lines) t0),
reviews_like AS (
  SELECT CAST(event_id AS VARCHAR) AS review_id, user_id * 100 + 1 AS tmdb_id,
         CASE WHEN value / 49.0 < 0 OR value / 49.0 > 10 THEN NULL
              ELSE value / 49.0 END AS rating
  FROM events WHERE user_id * 100 + 1 IN (SELECT l_orderkey * 100 + l_linenumber FROM lineitem)),
people_like AS (
  SELECT CAST(s_suppkey AS BIGINT) AS tmdb_id, s_name AS name, s_acctbal AS popularity
  FROM supplier WHERE s_suppkey > 0)
"""


def _with(body: str, extra: str = "") -> str:
    ctes = LOOKALIKE_CTES.strip() + ("," + extra if extra else "")
    return f"WITH {ctes}\n{body}"


# ------------------------------------------------------------------ questions


def q_revenue_by_year(spark, d):
    return to_double(Q.revenue_by_year(LA.stored(spark, d, "movies")))


ORACLE_REVENUE_BY_YEAR_BODY = """
SELECT release_year, COUNT(*) AS n_movies,
       CAST(ROUND(SUM(revenue_usd), 2) AS DOUBLE) AS revenue_usd_total,
       CAST(ROUND(SUM(revenue_cop), 2) AS DOUBLE) AS revenue_cop_total,
       ROUND(AVG(roi_pct), 2) AS avg_roi_pct
FROM titles
WHERE release_year IS NOT NULL AND release_year >= 1980
  AND revenue_usd IS NOT NULL AND revenue_cop IS NOT NULL
GROUP BY release_year HAVING COUNT(*) >= 5"""


def q_revenue_by_year_rate(spark, d):
    return to_double(_sql(spark, d, lambda v: QS.q3_revenue_by_year_rate(v=v)))


def q_revenue_by_token(spark, d):
    return to_double(Q.revenue_by_genre(LA.stored(spark, d, "movies")))


def _genre_oracle(where: str, names: dict, limit: str = "") -> str:
    extra = f"""
g AS (SELECT tmdb_id, revenue_usd, revenue_cop, trim(unnest(string_split(genres, ','))) AS genre
      FROM titles WHERE genres IS NOT NULL AND {where}),
agg AS (SELECT genre, COUNT(DISTINCT tmdb_id) AS n,
               SUM(revenue_usd) AS su, SUM(revenue_cop) AS sc, COUNT(revenue_usd) AS n1, COUNT(revenue_cop) AS n2
        FROM g WHERE genre <> '' GROUP BY genre)"""
    body = f"""
SELECT genre, n AS {names['n']},
       CAST(ROUND(su, 2) AS DOUBLE) AS {names['su']},
       {_mean('su', 'n1', 2)} AS {names['au']},
       CAST(ROUND(sc, 2) AS DOUBLE) AS {names['sc']},
       {_mean('sc', 'n2', 2)} AS {names['ac']}
FROM agg ORDER BY {names['su']} DESC, genre {limit}"""
    return _with(body, extra)


def q_revenue_by_token_bridge(spark, d):
    """D1 with the reference's plan: the genre bridge (T7) joined to titles."""
    t = LA.stored(spark, d, "movies")
    return to_double(Q.revenue_by_genre(t, genre_bridge(t)))


def q_revenue_by_token_sql(spark, d):
    return to_double(_sql(spark, d, lambda v: QS.q1_genre_revenue(v=v), joined=("movies", "movie_genres")))


def q_top_suppliers_profitable(spark, d):
    return to_double(Q.top_actors_rentables(LA.stored(spark, d, "movies"), LA.stored(spark, d, "people")))


def _actor_oracle(sql_variant: bool) -> str:
    cond = "" if sql_variant else " AND trim(cast_ids) <> ''"
    extra = f"""
c AS (SELECT tmdb_id, profit_usd, revenue_usd, unnest(string_split(cast_ids, ',')) AS tok
      FROM titles WHERE profit_usd IS NOT NULL AND profit_usd > 0 AND cast_ids IS NOT NULL{cond}),
c2 AS (SELECT tmdb_id, profit_usd, revenue_usd, {duck_int('tok', 'BIGINT')} AS actor_id FROM c
       {"WHERE trim(tok) <> ''" if sql_variant else ""}),
per AS (SELECT actor_id, COUNT(DISTINCT tmdb_id) AS n,
               SUM(profit_usd) AS s, COUNT(profit_usd) AS k, SUM(revenue_usd) AS sr
        FROM c2 WHERE actor_id IS NOT NULL GROUP BY actor_id)"""
    avg = _mean("s", "k", 2)
    if sql_variant:
        body = f"""
SELECT p.tmdb_id, p.name AS actor, per.n AS peliculas_rentables, {avg} AS avg_profit_usd
FROM per JOIN people_like p ON per.actor_id = p.tmdb_id
ORDER BY peliculas_rentables DESC, avg_profit_usd DESC, p.tmdb_id LIMIT 25"""
    else:
        body = f"""
SELECT p.tmdb_id AS actor_id, p.name AS actor_name, per.n AS n_movies_rentables,
       {avg} AS avg_profit_usd, CAST(ROUND(per.sr, 2) AS DOUBLE) AS total_revenue_usd
FROM per JOIN people_like p ON per.actor_id = p.tmdb_id
ORDER BY n_movies_rentables DESC, avg_profit_usd DESC, actor_id LIMIT 25"""
    return _with(body, extra)


def q_top_suppliers_profitable_sql(spark, d):
    return to_double(_sql(spark, d, lambda v: QS.q2_profitable_actors(v=v)))


def q_roi_by_token(spark, d):
    return to_double(Q.roi_by_director(LA.stored(spark, d, "movies")))


def _director_oracle(sql_variant: bool) -> str:
    extra = f"""
dd AS (SELECT tmdb_id, roi_pct, profit_usd, revenue_usd, budget_usd,
              trim(unnest(string_split(directors, ','))) AS director_name
       FROM titles WHERE directors IS NOT NULL {"" if sql_variant else "AND trim(directors) <> ''"}),
agg AS (SELECT director_name, COUNT(DISTINCT tmdb_id) AS n, AVG(roi_pct) AS ar,
               AVG(CASE WHEN budget_usd IS NOT NULL AND budget_usd > 0 THEN
                   (CAST(revenue_usd * (SELECT rate FROM fxrate) AS DOUBLE)
                    - CAST(budget_usd * (SELECT rate FROM fxrate) AS DOUBLE))
                   / CAST(budget_usd * (SELECT rate FROM fxrate) AS DOUBLE) * 100 END) AS aadj,
               SUM(profit_usd) AS s, COUNT(profit_usd) AS k, SUM(revenue_usd) AS sr
        FROM dd WHERE director_name <> '' AND roi_pct IS NOT NULL
        GROUP BY director_name HAVING COUNT(DISTINCT tmdb_id) >= 3)"""
    avg = _mean("s", "k", 2)
    if sql_variant:
        body = f"""
SELECT director_name AS director, n AS peliculas, ROUND(ar, 2) AS avg_roi_pct,
       ROUND(aadj, 2) AS avg_roi_adjusted_cop, {avg} AS avg_profit_usd,
       CAST(ROUND(sr, 2) AS DOUBLE) AS total_revenue_usd
FROM agg WHERE EXISTS (SELECT 1 FROM fxrate)
ORDER BY avg_roi_pct DESC, director LIMIT 20"""
    else:
        body = f"""
SELECT director_name, n AS n_movies, ROUND(ar, 2) AS avg_roi_pct, {avg} AS avg_profit_usd,
       CAST(ROUND(sr, 2) AS DOUBLE) AS total_revenue_usd
FROM agg ORDER BY avg_roi_pct DESC, director_name LIMIT 20"""
    return _with(body, extra)


def q_roi_by_token_fx(spark, d):
    return to_double(_sql(spark, d, lambda v: QS.q4_director_roi_fx(code=LA.FX_CODE, v=v)))


def q_rating_correlations_left(spark, d):
    return Q.ratings_correlations(LA.stored(spark, d, "movies"), LA.stored(spark, d, "movie_reviews"))


_REVIEW_AGG = """
ra AS (SELECT tmdb_id, AVG(rating) AS avg_review_rating FROM reviews_like
       WHERE rating IS NOT NULL GROUP BY tmdb_id HAVING COUNT(*) >= 3)"""


_CORR_COLUMNS = [("corr_tmdb_revenue", "vote_average", "revenue_usd"), ("corr_tmdb_profit", "vote_average", "profit_usd"),
                 ("corr_tmdb_roi", "vote_average", "roi_pct"), ("corr_reviews_revenue", "avg_review_rating", "revenue_usd"),
                 ("corr_reviews_profit", "avg_review_rating", "profit_usd"), ("corr_reviews_roi", "avg_review_rating", "roi_pct")]
_CORR_COLUMNS_SQL = [("corr_nota_tmdb_vs_revenue", "vote_average", "revenue_usd"), ("corr_nota_tmdb_vs_profit", "vote_average", "profit_usd"),
                     ("corr_nota_tmdb_vs_roi", "vote_average", "roi_pct"), ("corr_resenas_vs_revenue", "avg_review_rating", "revenue_usd"),
                     ("corr_resenas_vs_profit", "avg_review_rating", "profit_usd"), ("corr_resenas_vs_roi", "avg_review_rating", "roi_pct")]


def _corr_oracle(names, left: bool) -> str:
    cols = ",\n       ".join(f"ROUND(CORR({x}, {y}), 4) AS {n}" for n, x, y in names)
    join = "LEFT JOIN" if left else "JOIN"
    pos = " AND t.revenue_usd > 0" if left else ""
    body = f"""
SELECT {cols}
FROM titles t {join} ra ON t.tmdb_id = ra.tmdb_id
WHERE t.vote_average IS NOT NULL AND t.revenue_usd IS NOT NULL{pos}"""
    return _with(body, _REVIEW_AGG)


def q_rating_correlations_inner(spark, d):
    return _sql(spark, d, lambda v: QS.q5_correlations(digits=4, v=v))


def q_hash_sample(spark, d):
    return to_double(Q.ratings_vs_revenue_sample(LA.stored(spark, d, "movies"), LA.stored(spark, d, "movie_reviews"), mode="hash"))


ORACLE_HASH_SAMPLE = _with("""
SELECT t.tmdb_id, t.title, t.vote_average, CAST(t.revenue_usd AS DOUBLE) AS revenue_usd,
       CAST(t.profit_usd AS DOUBLE) AS profit_usd, ROUND(ra.avg_review_rating, 2) AS avg_review_rating
FROM titles t LEFT JOIN ra ON t.tmdb_id = ra.tmdb_id
WHERE t.vote_average IS NOT NULL AND t.revenue_usd IS NOT NULL AND t.revenue_usd > 0
ORDER BY md5('42:' || CAST(t.tmdb_id AS VARCHAR)), t.tmdb_id LIMIT 2000""", _REVIEW_AGG)


# ------------------------------------------------------------------ KPIs / display


def q_global_kpis(spark, d):
    k = kpi.global_kpis(Q.revenue_by_year(LA.stored(spark, d, "movies")))
    return to_double(kpi.kpi_text(k, keep=True).drop("roi_pct"))


ORACLE_GLOBAL_KPIS = _with("""
SELECT n_movies, revenue_usd, revenue_cop,
       format('{:,.0f}', CAST(n_movies AS DOUBLE)) AS n_movies_text,
       '$' || format('{:,.2f}', revenue_usd / 1e9) || 'B' AS revenue_usd_text,
       '$' || format('{:,.2f}', revenue_cop / 1e12) || 'T' AS revenue_cop_text,
       format('{:,.1f}', roi) || '%' AS roi_pct_text
FROM (SELECT CAST(SUM(n_movies) AS BIGINT) AS n_movies, CAST(SUM(su) AS DOUBLE) AS revenue_usd,
             CAST(SUM(sc) AS DOUBLE) AS revenue_cop,
             SUM(avg_roi_pct * n_movies) / SUM(n_movies) AS roi
      FROM (SELECT COUNT(*) AS n_movies, ROUND(SUM(revenue_usd), 2) AS su, ROUND(SUM(revenue_cop), 2) AS sc,
                   ROUND(AVG(roi_pct), 2) AS avg_roi_pct
            FROM titles WHERE release_year IS NOT NULL AND release_year >= 1980
              AND revenue_usd IS NOT NULL AND revenue_cop IS NOT NULL
            GROUP BY release_year HAVING COUNT(*) >= 5))""")


def q_corr_text(spark, d):
    return kpi.correlation_text(Q.ratings_correlations(LA.stored(spark, d, "movies"), LA.stored(spark, d, "movie_reviews")))


def q_top15_display(spark, d):
    return to_double(kpi.genre_feed(Q.revenue_by_genre(LA.stored(spark, d, "movies"))))


def q_year_display(spark, d):
    return to_double(kpi.year_feed(Q.revenue_by_year(LA.stored(spark, d, "movies"))))


def q_director_display(spark, d):
    return to_double(kpi.director_feed(Q.roi_by_director(LA.stored(spark, d, "movies"))))


def q_actor_display(spark, d):
    return to_double(kpi.actor_feed(Q.top_actors_rentables(LA.stored(spark, d, "movies"), LA.stored(spark, d, "people"))))


def q_scatter_display(spark, d):
    s = Q.ratings_vs_revenue_sample(LA.stored(spark, d, "movies"), LA.stored(spark, d, "movie_reviews"), mode="hash")
    return to_double(kpi.scatter_feed(s))


def q_display_axis_ranges(spark, d):
    t = LA.stored(spark, d, "movies")
    g = kpi.axis_max(kpi.top_then_resort(Q.revenue_by_genre(t), 15, "revenue_usd_total", key="genre"),
                     "revenue_usd_total", 1.15, kpi.USD_BILLIONS, "genres")
    a = kpi.axis_max(Q.top_actors_rentables(t, LA.stored(spark, d, "people")), "n_movies_rentables", 1.12, chart="actors")
    r = kpi.axis_max(Q.roi_by_director(t), "avg_roi_pct", 1.15, chart="directors")
    return g.unionByName(a).unionByName(r)


def _renamed(inner: str, captions: dict, extra: str = "") -> str:
    cols = ", ".join(f'{k} AS "{v}"' for k, v in captions.items())
    return f"SELECT {cols}{extra} FROM ({inner}) x"


# ------------------------------------------------------------------ cleaning operators


def q_null_normalize(spark, d):
    c = LA.table(spark, d, "customer")
    return c.select("c_custkey", C.known_text(F.col("c_name")).alias("c_name"),
                    C.known_text(F.col("c_mktsegment")).alias("c_mktsegment"),
                    C.known_text(F.col("c_acctbal").cast("decimal(18,2)")).alias("acct_text"))


ORACLE_NULL_NORMALIZE = f"""
SELECT c_custkey,
       CASE WHEN trim(c_name) IN ({_NULL_LIKE_SQL}) THEN NULL ELSE trim(c_name) END AS c_name,
       CASE WHEN trim(c_mktsegment) IN ({_NULL_LIKE_SQL}) THEN NULL ELSE trim(c_mktsegment) END AS c_mktsegment,
       trim(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)) AS acct_text
FROM customer"""


def q_cast_int_double_bool(spark, d):
    c = LA.table(spark, d, "customer")
    t = c.select("c_custkey",
                 F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("acct"),
                 F.concat(F.lit(" "), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("nation"),
                 (F.col("c_acctbal") > 0).cast("string").alias("positive"))
    return t.select("c_custkey", C.whole(F.col("acct")).alias("acct_int"),
                    C.real(F.col("acct")).alias("acct_double"),
                    C.whole(F.col("nation")).alias("nation_int"),
                    C.truth(F.col("positive")).alias("positive_bool"))


ORACLE_CAST = f"""
SELECT c_custkey, {duck_int('acct')} AS acct_int, TRY_CAST(trim(acct) AS DOUBLE) AS acct_double,
       {duck_int('nation')} AS nation_int,
       CASE WHEN lower(trim(positive)) IN ('true', '1', 'yes') THEN TRUE
            WHEN lower(trim(positive)) IN ('false', '0', 'no') THEN FALSE END AS positive_bool
FROM (SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS acct,
             ' ' || CAST(c_nationkey AS VARCHAR) || ' ' AS nation,
             CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END AS positive
      FROM customer)"""


def q_normalize_token_list(spark, d):
    p = LA.table(spark, d, "part")
    raw = F.concat_ws(",,", F.concat(F.col("p_brand"), F.lit(" ,"), F.col("p_type")), F.col("p_name"))
    return p.select("p_partkey", C.token_list(raw).alias("tokens"))


ORACLE_NORMALIZE = f"""
SELECT p_partkey, CASE WHEN g IN ({_NULL_LIKE_SQL}) THEN NULL ELSE g END AS tokens
FROM (SELECT p_partkey,
             regexp_replace(regexp_replace(lower(trim(p_brand || ' ,' || p_type || ',,' || p_name)),
                            '\\s*,\\s*', ', ', 'g'), ',\\s*,', ', ', 'g') AS g
      FROM part)"""


def q_null_negative_amounts(spark, d):
    c = LA.table(spark, d, "customer")
    return c.select("c_custkey", C.not_negative(F.col("c_acctbal")).alias("c_acctbal"))


ORACLE_NULL_NEG = "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer"


def q_range_null_rating(spark, d):
    e = LA.table(spark, d, "events")
    return e.select("event_id", C.within(F.col("value") / F.lit(LA.RATING_DIVISOR), 0, 10).alias("rating"))


ORACLE_RANGE = f"""
SELECT event_id, CASE WHEN value / 49.0 < 0 OR value / 49.0 > 10 THEN NULL
                      ELSE value / 49.0 END AS rating FROM events"""


def q_bucket_three_way(spark, d):
    e = LA.table(spark, d, "events")
    return e.select("event_id", "value", C.three_way(F.col("value")).alias("bucket"))


ORACLE_BUCKET = """
SELECT event_id, value, CASE WHEN value > 300 THEN 'high' WHEN value > 100 THEN 'medium' ELSE 'low' END AS bucket
FROM events"""


def q_upper_code(spark, d):
    e = LA.table(spark, d, "events")
    return e.select("event_id", C.code(F.concat(F.lit(" "), F.col("event_type"))).alias("code"))


ORACLE_UPPER = "SELECT event_id, upper(trim(' ' || event_type)) AS code FROM events"


def q_keep_latest_per_user(spark, d):
    e = LA.table(spark, d, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return best_per_key(e, "user_id", "ts", ties="event_id").drop("ts")


ORACLE_LATEST_USER = """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1"""

_LI_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def q_dedupe_lineitem(spark, d):
    li = LA.table(spark, d, "lineitem").drop("l_shipdate")
    return best_per_key(li, ["l_orderkey", "l_linenumber"], "l_extendedprice", ties=_LI_TIES)


ORACLE_DEDUPE_LI = f"""
SELECT * EXCLUDE (l_shipdate) FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_extendedprice DESC NULLS LAST, {', '.join(c + ' DESC NULLS LAST' for c in _LI_TIES)}) = 1"""


def q_semi_join_known_parents(spark, d):
    o = LA.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    c = LA.table(spark, d, "customer").where(F.col("c_acctbal") >= 0)
    return keep_known(o, c, "o_custkey", "c_custkey")


ORACLE_SEMI = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""


def q_distinct_title_keys(spark, d):
    """Distinct (order, line) keys of lineitem, i.e. the look-alike title keys."""
    return distinct_keys(LA.table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


ORACLE_DISTINCT_KEYS = "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem"


# ------------------------------------------------------------------ finance / multi-value / sources


def q_profit_and_roi(spark, d):
    return to_double(LA.titles(spark, d).select("tmdb_id", "profit_usd", "roi_pct"))


def q_fx_convert_broadcast(spark, d):
    return to_double(LA.titles(spark, d).select("tmdb_id", "revenue_usd", "revenue_cop"))


def q_fx_roi_adjusted(spark, d):
    fx = LA.exchange(spark, d).where(F.col("currency") == LA.FX_CODE).select(F.col("rate").alias("cop_rate"))
    t = cross_scalar(LA.titles(spark, d), fx)
    return t.select("tmdb_id", "roi_pct", roi_local().alias("roi_adjusted"))


ORACLE_FX_ROI = _with("""
SELECT tmdb_id, roi_pct,
       CASE WHEN budget_usd IS NOT NULL AND budget_usd > 0 THEN
            (CAST(revenue_usd * r.rate AS DOUBLE) - CAST(budget_usd * r.rate AS DOUBLE))
            / CAST(budget_usd * r.rate AS DOUBLE) * 100 END AS roi_adjusted
FROM titles, (SELECT rate FROM fxrate) r""")


def q_token_bridge(spark, d):
    return genre_bridge(LA.titles(spark, d))


ORACLE_BRIDGE = _with("""
SELECT tmdb_id, genre FROM (
  SELECT tmdb_id, trim(unnest(string_split(genres, ','))) AS genre FROM titles WHERE genres IS NOT NULL)
WHERE genre <> ''""")


def q_rates_map_explode(spark, d):
    return LA.raw_rates(spark, d).withColumn("rate", F.col("rate").cast("double"))


ORACLE_RATES = _with("SELECT currency, CAST(rate_text AS DOUBLE) AS rate, base, date FROM rates_raw")


def q_exchange_clean(spark, d):
    return to_double(LA.exchange(spark, d).select("currency", "rate"))


ORACLE_EXCHANGE = _with("SELECT currency, CAST(rate AS DOUBLE) AS rate FROM exchange_like")


def q_trusted_reviews(spark, d):
    return LA.reviews(spark, d).select("review_id", "tmdb_id", "rating")


ORACLE_REVIEWS = _with("SELECT review_id, CAST(tmdb_id AS BIGINT) AS tmdb_id, rating FROM reviews_like")


def q_people_clean(spark, d):
    return LA.people(spark, d).select("tmdb_id", "name", "popularity")


ORACLE_PEOPLE = _with("SELECT tmdb_id, name, popularity FROM people_like")


def q_titles_from_raw(spark, d):
    base = LA.base_titles(spark, d)
    raw = base.select([F.col(c).cast("string").alias(c) for c in
                       ("tmdb_id", "title", "release_year", "revenue_usd", "budget_usd",
                        "vote_average", "vote_count", "genres", "cast_ids", "directors")])
    return clean_movies(raw).select("tmdb_id", "title", "release_year", "revenue_usd", "budget_usd",
                                    "vote_average", "vote_count", "genres")


ORACLE_TITLES_RAW = _with("""
SELECT CAST(tmdb_id AS BIGINT) AS tmdb_id, title, release_year, CAST(revenue_usd AS DOUBLE) AS revenue_usd,
       CAST(budget_usd AS DOUBLE) AS budget_usd, vote_average, vote_count, genres
FROM titles WHERE tmdb_id > 0""")


def q_tv_clean(spark, d):
    """T2 on a raw-text look-alike: customers as shows, balance / 20 as popularity."""
    c = LA.table(spark, d, "customer")
    raw = c.select(F.col("c_custkey").cast("string").alias("tmdb_id"),
                   F.col("c_name").alias("title"),
                   F.col("c_nationkey").cast("string").alias("vote_count"),
                   (F.col("c_acctbal") / F.lit(20.0)).cast("string").alias("popularity"),
                   F.when(F.col("c_mktsegment") == "BUILDING", "yes").otherwise("no").alias("in_production"),
                   F.lower(F.col("c_mktsegment")).alias("genres"))
    return clean_tv(raw, ties="title").select("tmdb_id", "title", "vote_count", "popularity",
                                                   "in_production", "genres", "popularity_bucket")


ORACLE_TV = """
SELECT CAST(c_custkey AS BIGINT) AS tmdb_id, c_name AS title, c_nationkey AS vote_count,
       c_acctbal / 20.0 AS popularity, c_mktsegment = 'BUILDING' AS in_production,
       lower(c_mktsegment) AS genres,
       CASE WHEN c_acctbal / 20.0 > 300 THEN 'high' WHEN c_acctbal / 20.0 > 100 THEN 'medium' ELSE 'low' END
           AS popularity_bucket
FROM customer WHERE c_custkey > 0"""


def q_lake_job_trusted_movies(spark, d):
    """T8 end to end: land raw-text look-alikes of all five sources as CSV in the
    shared folder, run the raw -> trusted job (six Parquet tables), return trusted
    movies."""
    import uuid

    from trilake.plans.trusted import raw_to_trusted
    from trilake.session import shared_dir
    from trilake.sources.raw_csv import ingest_all
    root = shared_dir(spark, "lake_job", uuid.uuid4().hex)
    c = LA.table(spark, d, "customer")
    sources = {
        "movies": LA.base_titles(spark, d),
        "tv_shows": c.select(F.col("c_custkey").alias("tmdb_id"), F.col("c_name").alias("title"),
                             (F.col("c_acctbal") / F.lit(20.0)).alias("popularity")),
        "people": LA.table(spark, d, "supplier").select(F.col("s_suppkey").alias("tmdb_id"),
                                                        F.col("s_name").alias("name")),
        "movie_reviews": LA.raw_reviews(spark, d),
        "exchange": LA.raw_rates(spark, d),
    }
    ingest_all(sources, f"{root}/raw", run_ts="20240101_000000")
    raw_to_trusted(spark, f"{root}/raw", f"{root}/trusted", code=LA.FX_CODE)
    from trilake.sources.parquet import read_table
    return read_table(spark, f"{root}/trusted", "movies").select(
        "tmdb_id", "release_year", "revenue_usd", "budget_usd", "profit_usd", "roi_pct", "revenue_cop")


ORACLE_LAKE_JOB = _with("""
SELECT CAST(tmdb_id AS BIGINT) AS tmdb_id, release_year, CAST(revenue_usd AS DOUBLE) AS revenue_usd,
       CAST(budget_usd AS DOUBLE) AS budget_usd,
       CAST(revenue_usd AS DOUBLE) - CAST(budget_usd AS DOUBLE) AS profit_usd,
       CASE WHEN budget_usd > 0 THEN CAST(revenue_usd AS DOUBLE) / CAST(budget_usd AS DOUBLE) * 100 END AS roi_pct,
       CAST(revenue_usd AS DOUBLE) * CAST((SELECT rate FROM fxrate) AS DOUBLE) AS revenue_cop
FROM titles WHERE tmdb_id > 0""")


def q_incremental_titles(spark, d):
    """ST1 on a lake table: titles landed as raw CSV in two runs (release years up to
    1997, then the rest), each run processed by the streaming job, current trusted
    table returned."""
    import uuid

    from trilake.session import shared_dir
    from trilake.sources.raw_csv import land_raw
    from trilake.streaming.incremental import incremental_trusted
    base = shared_dir(spark, "incremental_titles", uuid.uuid4().hex)
    t = kept(LA.base_titles(spark, d), "incremental_titles")  # both runs are cut from it
    early = F.col("release_year") <= 1997
    out = None
    for i, cond in enumerate([early, ~early | F.col("release_year").isNull()]):
        land_raw(t.where(cond), f"{base}/raw", "movies", run_ts=f"run{i}")
        out = incremental_trusted(spark, f"{base}/raw/movies", "movies", f"{base}/changes", f"{base}/ckpt")
    return out.select("tmdb_id", "title", "release_year", "revenue_usd", "budget_usd",
                      "vote_average", "vote_count", "genres")


def q_exchange_latest(spark, d):
    """T5 in ``latest`` mode: the rate of the newest landing (here the document date)
    per currency, highest rate among equal dates (B4's alternative)."""
    return clean_exchange(LA.raw_rates(spark, d), mode="latest", landed="date").select("currency", "rate", "date")


ORACLE_EXCHANGE_LATEST = _with(f"""
SELECT currency, rate, date FROM (
  SELECT upper(trim(currency)) AS currency, TRY_CAST(trim(rate_text) AS DOUBLE) AS rate, date,
         row_number() OVER (PARTITION BY upper(trim(currency))
                            ORDER BY date DESC NULLS LAST, TRY_CAST(trim(rate_text) AS DOUBLE) DESC NULLS LAST) AS rn
  FROM rates_raw
  WHERE trim(currency) NOT IN ({_NULL_LIKE_SQL}) AND TRY_CAST(trim(rate_text) AS DOUBLE) > 0)
WHERE rn = 1""")


def q_trusted_row_counts(spark, d):
    """Row-count smoke check of the trusted look-alike tables, one row per table."""
    from trilake.sources.parquet import row_counts
    return row_counts(LA.trusted(spark, d))


ORACLE_ROW_COUNTS = _with("""
SELECT 'movies' AS table_name, COUNT(*) AS n FROM titles
UNION ALL SELECT 'movie_genres', COUNT(*) FROM (
  SELECT trim(unnest(string_split(genres, ','))) AS g FROM titles WHERE genres IS NOT NULL) WHERE g <> ''
UNION ALL SELECT 'people', COUNT(*) FROM people_like
UNION ALL SELECT 'movie_reviews', COUNT(*) FROM reviews_like
UNION ALL SELECT 'exchange', COUNT(*) FROM exchange_like""")


# ------------------------------------------------------------------ registry


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from trilake import contract_jobs
    from trilake.streaming.incremental import q_incremental_latest
    from trilake.sources.raw_csv import q_raw_roundtrip, q_raw_split_roundtrip
    return contract_jobs.queries() | {
        "revenue_by_year": q_revenue_by_year,
        "revenue_by_year_rate": q_revenue_by_year_rate,
        "revenue_by_token": q_revenue_by_token,
        "revenue_by_token_bridge": q_revenue_by_token_bridge,
        "revenue_by_token_sql": q_revenue_by_token_sql,
        "top_suppliers_profitable": q_top_suppliers_profitable,
        "top_suppliers_profitable_sql": q_top_suppliers_profitable_sql,
        "roi_by_token": q_roi_by_token,
        "roi_by_token_fx": q_roi_by_token_fx,
        "rating_correlations_left": q_rating_correlations_left,
        "rating_correlations_inner": q_rating_correlations_inner,
        "hash_sample": q_hash_sample,
        "global_kpis": q_global_kpis,
        "corr_text": q_corr_text,
        "top15_display": q_top15_display,
        "year_display": q_year_display,
        "director_display": q_director_display,
        "actor_display": q_actor_display,
        "scatter_display": q_scatter_display,
        "display_axis_ranges": q_display_axis_ranges,
        "null_normalize": q_null_normalize,
        "cast_int_double_bool": q_cast_int_double_bool,
        "normalize_token_list": q_normalize_token_list,
        "null_negative_amounts": q_null_negative_amounts,
        "range_null_rating": q_range_null_rating,
        "bucket_three_way": q_bucket_three_way,
        "upper_code": q_upper_code,
        "keep_latest_per_user": q_keep_latest_per_user,
        "dedupe_lineitem": q_dedupe_lineitem,
        "semi_join_known_parents": q_semi_join_known_parents,
        "distinct_title_keys": q_distinct_title_keys,
        "profit_and_roi": q_profit_and_roi,
        "fx_convert_broadcast": q_fx_convert_broadcast,
        "fx_roi_adjusted": q_fx_roi_adjusted,
        "token_bridge": q_token_bridge,
        "rates_map_explode": q_rates_map_explode,
        "exchange_clean": q_exchange_clean,
        "trusted_reviews": q_trusted_reviews,
        "people_clean": q_people_clean,
        "titles_from_raw": q_titles_from_raw,
        "tv_clean": q_tv_clean,
        "incremental_titles": q_incremental_titles,
        "exchange_latest": q_exchange_latest,
        "trusted_row_counts": q_trusted_row_counts,
        "lake_job_trusted_movies": q_lake_job_trusted_movies,
        "incremental_latest": q_incremental_latest,
        "raw_roundtrip": q_raw_roundtrip,
        "raw_split_roundtrip": q_raw_split_roundtrip,
    }


def oracle_sql() -> dict[str, str]:
    from trilake import contract_jobs
    from trilake.sources.raw_csv import ORACLE_RAW_ROUNDTRIP, ORACLE_RAW_SPLIT
    from trilake.streaming.incremental import ORACLE_INCREMENTAL
    genre_df = {"n": "n_movies", "su": "revenue_usd_total", "au": "revenue_usd_avg",
                "sc": "revenue_cop_total", "ac": "revenue_cop_avg"}
    genre_sql = {"n": "num_peliculas", "su": "total_revenue_usd", "au": "avg_revenue_usd",
                 "sc": "total_revenue_cop", "ac": "avg_revenue_cop"}
    return contract_jobs.oracle_sql() | {
        "revenue_by_year": _with(ORACLE_REVENUE_BY_YEAR_BODY + " ORDER BY release_year"),
        "revenue_by_year_rate": _with("""
SELECT release_year, COUNT(*) AS peliculas,
       CAST(ROUND(SUM(revenue_usd), 2) AS DOUBLE) AS total_revenue_usd,
       CAST(ROUND(SUM(revenue_cop), 2) AS DOUBLE) AS total_revenue_cop,
       ROUND(AVG(CAST(revenue_cop AS DOUBLE) / NULLIF(CAST(revenue_usd AS DOUBLE), 0)), 4) AS tasa_cop_aplicada
FROM titles WHERE release_year IS NOT NULL AND revenue_usd IS NOT NULL AND revenue_cop IS NOT NULL
GROUP BY release_year HAVING COUNT(*) >= 5 ORDER BY release_year"""),
        "revenue_by_token": _genre_oracle("revenue_usd IS NOT NULL AND revenue_cop IS NOT NULL AND revenue_usd > 0",
                                          genre_df),
        "revenue_by_token_bridge": _genre_oracle("revenue_usd IS NOT NULL AND revenue_cop IS NOT NULL AND revenue_usd > 0",
                                                 genre_df),
        "revenue_by_token_sql": _genre_oracle("revenue_usd IS NOT NULL AND revenue_cop IS NOT NULL",
                                              genre_sql, "LIMIT 20"),
        "top_suppliers_profitable": _actor_oracle(False),
        "top_suppliers_profitable_sql": _actor_oracle(True),
        "roi_by_token": _director_oracle(False),
        "roi_by_token_fx": _director_oracle(True),
        "rating_correlations_left": _corr_oracle(_CORR_COLUMNS, left=True),
        "rating_correlations_inner": _corr_oracle(_CORR_COLUMNS_SQL, left=False),
        "hash_sample": ORACLE_HASH_SAMPLE,
        "global_kpis": ORACLE_GLOBAL_KPIS,
        "corr_text": _corr_text_oracle(),
        "top15_display": _top15_oracle(),
        "year_display": _renamed(_with(ORACLE_REVENUE_BY_YEAR_BODY), kpi.YEAR_CAPTIONS,
                                 ", revenue_usd_total / 1e9 AS revenue_usd_billions"
                                 ", revenue_cop_total / 1e12 AS revenue_cop_trillions"),
        "director_display": _renamed(_director_oracle(False), kpi.DIRECTOR_CAPTIONS),
        "actor_display": _renamed(_actor_oracle(False), kpi.ACTOR_CAPTIONS),
        "scatter_display": f"SELECT *, revenue_usd / 1e6 AS revenue_usd_millions FROM ({ORACLE_HASH_SAMPLE}) x",
        "display_axis_ranges": f"""
SELECT 'genres' AS chart, MAX(revenue_usd_total) / 1e9 * 1.15 AS axis_max FROM ({_top15_oracle_raw()}) g
UNION ALL
SELECT 'actors', CAST(MAX(n_movies_rentables) AS DOUBLE) * 1.12 FROM ({_actor_oracle(False)}) a
UNION ALL
SELECT 'directors', MAX(avg_roi_pct) * 1.15 FROM ({_director_oracle(False)}) r""",
        "null_normalize": ORACLE_NULL_NORMALIZE,
        "cast_int_double_bool": ORACLE_CAST,
        "normalize_token_list": ORACLE_NORMALIZE,
        "null_negative_amounts": ORACLE_NULL_NEG,
        "range_null_rating": ORACLE_RANGE,
        "bucket_three_way": ORACLE_BUCKET,
        "upper_code": ORACLE_UPPER,
        "keep_latest_per_user": ORACLE_LATEST_USER,
        "dedupe_lineitem": ORACLE_DEDUPE_LI,
        "semi_join_known_parents": ORACLE_SEMI,
        "distinct_title_keys": ORACLE_DISTINCT_KEYS,
        "profit_and_roi": _with("SELECT tmdb_id, CAST(profit_usd AS DOUBLE) AS profit_usd, roi_pct FROM titles"),
        "fx_convert_broadcast": _with("SELECT tmdb_id, CAST(revenue_usd AS DOUBLE) AS revenue_usd, "
                                      "CAST(revenue_cop AS DOUBLE) AS revenue_cop FROM titles"),
        "fx_roi_adjusted": ORACLE_FX_ROI,
        "token_bridge": ORACLE_BRIDGE,
        "rates_map_explode": ORACLE_RATES,
        "exchange_clean": ORACLE_EXCHANGE,
        "trusted_reviews": ORACLE_REVIEWS,
        "people_clean": ORACLE_PEOPLE,
        "titles_from_raw": ORACLE_TITLES_RAW,
        "tv_clean": ORACLE_TV,
        "incremental_titles": ORACLE_TITLES_RAW,
        "lake_job_trusted_movies": ORACLE_LAKE_JOB,
        "exchange_latest": ORACLE_EXCHANGE_LATEST,
        "trusted_row_counts": ORACLE_ROW_COUNTS,
        "incremental_latest": ORACLE_INCREMENTAL,
        "raw_roundtrip": ORACLE_RAW_ROUNDTRIP,
        "raw_split_roundtrip": ORACLE_RAW_SPLIT,
    }


def _corr_text_oracle() -> str:
    inner = _corr_oracle(_CORR_COLUMNS, left=True)
    cols = ", ".join(
        f"CASE WHEN {n} IS NULL OR isnan({n}) THEN 'n/d' ELSE printf('%+.3f', {n}) END AS {n}_text"
        for n, _, _ in _CORR_COLUMNS)
    return f"SELECT {cols} FROM ({inner}) x"


def _top15_oracle_raw() -> str:
    return _genre_oracle("revenue_usd IS NOT NULL AND revenue_cop IS NOT NULL AND revenue_usd > 0",
                         {"n": "n_movies", "su": "revenue_usd_total", "au": "revenue_usd_avg",
                          "sc": "revenue_cop_total", "ac": "revenue_cop_avg"}, "LIMIT 15")


def _top15_oracle() -> str:
    inner = _top15_oracle_raw()
    cap = kpi.GENRE_CAPTIONS
    cols = ", ".join(f'{k} AS "{v}"' for k, v in cap.items())
    return f"SELECT {cols}, revenue_usd_total / 1e9 AS revenue_usd_billions FROM ({inner}) x"
