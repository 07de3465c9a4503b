"""Hot keys: one key holds a third of all rows. Results must stay whole and exact,
and the plans must combine map-side before every shuffle."""

import random

from pyspark.sql import functions as F

from trilake.operators.dedupe import best_per_key
from trilake.plans import questions as Q


def _movies(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        hot = i % 3 == 0                      # a third of all titles share actor 7 and genre "hot"
        cast = "7" if hot else f"{rnd.randint(100, 400)},{rnd.randint(100, 400)}"
        genres = "hot" if hot else rnd.choice(["a", "b", "a, b"])
        rev = float(rnd.randint(1, 1000))
        bud = float(rnd.randint(1, 900))
        rows.append((i, rev, bud, rev - bud, rev / bud * 100, rev * 2, cast, genres, "Dir"))
    return spark.createDataFrame(rows, "tmdb_id long, revenue_usd double, budget_usd double, profit_usd double, "
                                       "roi_pct double, revenue_cop double, cast_ids string, genres string, "
                                       "directors string"), rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_actor_and_genre_stay_whole(spark):
    movies, rows = _movies(spark)
    people = spark.createDataFrame([(7, "Hot Actor")] + [(i, f"P{i}") for i in range(100, 401)],
                                   "tmdb_id int, name string")
    top = Q.top_actors_rentables(movies, people, k=5).collect()
    hot = [r for r in top if r["actor_id"] == 7][0]
    expect = [r for r in rows if r[0] % 3 == 0 and r[3] > 0]
    assert hot["n_movies_rentables"] == len(expect)
    assert abs(hot["total_revenue_usd"] - round(sum(r[1] for r in expect), 2)) < 1e-6
    g = {r["genre"]: r["n_movies"] for r in Q.revenue_by_genre(movies).collect()}
    assert g["hot"] == 1000
    plan = _plan(Q.top_actors_rentables(movies, people, k=5))
    # map-side partial aggregates exist below the shuffle on the actor key
    assert "partial_avg(profit_usd" in plan and "partial_count(" in plan and "distinct" not in plan
    assert "Exchange hashpartitioning(actor_id" in plan


def test_hot_key_dedupe_limits_before_exchange(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    out = best_per_key(df, "k", "v")
    got = {r["k"]: r["v"] for r in out.collect()}
    assert got[0] == 29997 and len(got) == 20001
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
