import random

from pyspark.sql import functions as F

from tests.conftest import rows
from trilake.operators import (
    add_profit_roi, attach_scalar, bridge, convert_currency, cross_scalar, id_rows,
    token_rows, hash_sample, keep_known, best_per_key, roi_local, sample_n,
)


# ---------------------------------------------------------------- W1 best_per_key

def test_best_per_key_orders_desc_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, None, 5, "a"), (1, 2000, 1, "b"), (1, 2000, 3, "c"),   # key 1: null year loses, higher votes wins
         (2, None, None, "d"),                                       # key 2: only row
         (3, 1990, 7, "e"), (3, 1990, 7, "f")],                      # key 3: full tie -> tie-break
        "k int, y int, v int, tag string")
    out = best_per_key(df, "k", "y", "v", ties="tag")
    assert rows(out, "k", "tag") == [(1, "c"), (2, "d"), (3, "f")]


def test_best_per_key_property_one_row_per_key_matches_bruteforce(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(0, 30), rnd.choice([None, *range(5)]), rnd.randint(0, 3), i) for i in range(600)]
    df = spark.createDataFrame(data, "k int, a int, b int, id int")
    got = {r["k"]: r["id"] for r in best_per_key(df, "k", "a", "b", ties="id").collect()}
    best = {}
    for k, a, b, i in data:
        key = (a is not None, a if a is not None else 0, b, i)
        if k not in best or key > best[k][0]:
            best[k] = (key, i)
    assert got == {k: v[1] for k, v in best.items()}


def test_best_per_key_plan_limits_before_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    plan = best_per_key(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# ---------------------------------------------------------------- M1-M4

def test_token_rows_trims_and_drops_blanks(spark):
    df = spark.createDataFrame([(1, "drama,  comedy, ,drama"), (2, None), (3, "  ")], "id int, g string")
    out = token_rows(df, "g", "genre", keep=["id"])
    assert rows(out) == [(1, "comedy"), (1, "drama"), (1, "drama")]   # duplicates kept (B5)


def test_bridge_distinct_option(spark):
    df = spark.createDataFrame([(1, "a, a, b")], "tmdb_id int, genres string")
    assert len(bridge(df, "tmdb_id", "genres", "genre").collect()) == 3
    assert rows(bridge(df, "tmdb_id", "genres", "genre", distinct=True)) == [(1, "a"), (1, "b")]


def test_id_rows_casts_and_drops_non_numeric(spark):
    df = spark.createDataFrame([(1, "3, 17,x,17, 4.0,,1e3")], "tmdb_id int, cast_ids string")
    out = id_rows(df, "cast_ids", "actor_id", keep=["tmdb_id"])
    assert rows(out) == [(1, 3), (1, 4), (1, 17), (1, 17)]


# ---------------------------------------------------------------- finance / joins

def test_profit_and_roi(spark):
    df = spark.createDataFrame(
        [(1, 100.0, 50.0), (2, 0.0, 10.0), (3, 10.0, 0.0), (4, None, 10.0), (5, 10.0, None)],
        "id int, revenue_usd double, budget_usd double")
    out = {r["id"]: (r["profit_usd"], r["roi_pct"]) for r in add_profit_roi(df).collect()}
    assert out == {1: (50.0, 200.0), 2: (-10.0, 0.0), 3: (10.0, None), 4: (None, None), 5: (None, None)}


def test_convert_currency_modes(spark):
    movies = spark.createDataFrame([(1, 10.0), (2, None)], "id int, revenue_usd double")
    ex = spark.createDataFrame([("COP", 4000.0), ("EUR", 0.9)], "currency string, rate double")
    got = dict(convert_currency(movies, ex).select("id", "revenue_cop").collect())
    assert got == {1: 40000.0, 2: None}
    no_cop = ex.where("currency <> 'COP'")
    assert dict(convert_currency(movies, no_cop).select("id", "revenue_cop").collect()) == {1: 10.0, 2: None}
    assert dict(convert_currency(movies, no_cop, on_missing="null")
                .select("id", "revenue_cop").collect()) == {1: None, 2: None}


def test_scalar_rate_plans(spark):
    movies = spark.createDataFrame([(1, 10.0)], "id int, revenue_usd double")
    ex = spark.createDataFrame([("COP", 4000.0)], "currency string, rate double")
    plan = convert_currency(movies, ex)._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "Join" not in plan
    pruned = convert_currency(movies, ex).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in pruned                 # unused conversion costs nothing
    joined = attach_scalar(movies, ex.select("rate"))._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in joined and "Join" not in joined


def test_cross_scalar_empty_when_no_rate_and_roi_local_identity(spark):
    movies = spark.createDataFrame([(1, 300.0, 100.0), (2, 50.0, 0.0)], "id int, revenue_usd double, budget_usd double")
    rate = spark.createDataFrame([(4000.0,)], "cop_rate double")
    out = cross_scalar(add_profit_roi(movies), rate).select("id", "roi_pct", roi_local().alias("adj"))
    for r in out.collect():
        if r["roi_pct"] is None:
            assert r["adj"] is None
        else:
            assert abs(r["adj"] - (r["roi_pct"] - 100)) < 1e-9   # X16 = roi_pct - 100
    assert cross_scalar(movies, rate.where("false")).count() == 0   # J4: no rate row -> empty
    assert attach_scalar(movies, rate.where("false")).count() == 2  # J3: rows kept


def test_keep_known_semi_join_never_adds_rows(spark):
    kids = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (9, "d")], "tmdb_id int, x string")
    parents = spark.createDataFrame([(1,), (1,), (2,)], "tmdb_id int")   # duplicated parent id
    out = keep_known(kids, parents, "tmdb_id")
    assert rows(out) == [(1, "a"), (1, "b"), (2, "c")]


# ---------------------------------------------------------------- O7 / O8

def test_hash_sample_is_deterministic_and_partition_independent(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r["k"] for r in hash_sample(df.repartition(3), 50, "k").collect()]
    b = [r["k"] for r in hash_sample(df.repartition(7), 50, "k").collect()]
    assert a == b and len(a) == 50


def test_bernoulli_sample_caps_at_n(spark):
    df = spark.range(1000)
    assert sample_n(df, 20).count() <= 20
    assert sample_n(df, 5000).count() == 1000


def test_bridge_tokens_rejoin_to_same_multiset(spark):
    """P5 + M3 property: normalising a list and exploding it into the bridge keeps
    exactly the lower-cased, trimmed, non-empty tokens (with repeats)."""
    from collections import Counter

    from trilake.functions.clean import token_list
    rnd = random.Random(11)
    vocab = ["Drama", "comedy", "ACTION", "sci fi", "x"]
    data = []
    for i in range(400):
        toks = [rnd.choice(vocab + ["", " "]) for _ in range(rnd.randint(0, 6))]
        seps = [rnd.choice([",", " ,", ", ", " , ", ",,"]) for _ in toks]
        data.append((i, "".join(t + s for t, s in zip(toks, seps)) if toks else None))
    df = spark.createDataFrame(data, "tmdb_id int, genres string").withColumn("genres", token_list(F.col("genres")))
    got = {}
    for r in bridge(df, "tmdb_id", "genres", "genre").collect():
        got.setdefault(r["tmdb_id"], Counter())[r["genre"]] += 1
    for i, text in data:
        want = Counter(t.strip(" ").lower() for t in (text or "").split(",") if t.strip(" "))
        assert got.get(i, Counter()) == want, (i, text)


def _scans(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_samples_move_few_rows(spark, tmp_dir):
    """O7 reads its input once; in O8 what passes the threshold does not grow with the tasks."""
    import re
    spark.range(60_000).selectExpr("id AS k", "id % 7 AS v").repartition(40).write.parquet(f"{tmp_dir}/t")
    df = spark.read.parquet(f"{tmp_dir}/t")
    drawn = sample_n(df, 100)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan", plan)) == 1
    got = [r.k for r in drawn.collect()]
    assert len(got) == len(set(got)) == 100
    assert len({tuple(sorted(r.k for r in sample_n(df, 100, seed=s).collect())) for s in (1, 2, 3)}) == 3
    assert sample_n(df, 100, total=60_000).count() == 100
    assert sample_n(df, 70_000).count() == 60_000 and sample_n(df.limit(0), 5).count() == 0
    import hashlib
    want = sorted(range(60_000), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())[:100]
    for parts in (1, 64):
        passed = hash_sample(df.repartition(parts), 100, "k")
        assert [r.k for r in passed.collect()] == want
    from trilake.operators.sample import _octave, hash_key
    octaves = {r.b: r["count"] for r in df.groupBy(_octave(hash_key("k")).alias("b")).count().collect()}
    level, seen = 0, 0
    while seen < 100:
        seen += octaves.get(level, 0)
        level += 1
    assert 100 <= seen <= 300  # rows that are sorted, in all
    assert [r.k for r in hash_sample(df, 60_001, "k").collect()][:100] == want and hash_sample(df.limit(0), 5, "k").count() == 0


def test_every_row_is_as_likely(spark):
    df = spark.range(200).repartition(8)
    hits = [0] * 200
    for seed in range(60):
        for r in sample_n(df, 20, seed=seed).collect():
            hits[r.id] += 1
    assert sum(hits) == 1200 and max(hits) <= 20 and sum(h == 0 for h in hits) <= 6


def test_sql_distinct_counts_shuffle_no_pairs(spark, tmp_dir):
    """Q1, Q2, Q4: no exchange on (token, title)."""
    import re

    from trilake.plans import questions_sql as QS
    movies = spark.createDataFrame(
        [(i, float(i), 1.0, float(i) - 1, 10.0 * i, 4.0 * i, "7,8,7" if i % 2 else " 8 , x", "Ann, Bob,Ann" if i % 3 else "Bob") for i in range(1, 40)],
        "tmdb_id long, revenue_usd double, budget_usd double, profit_usd double, roi_pct double, revenue_cop double, cast_ids string, directors string")
    genres = spark.createDataFrame([(i, g) for i in range(1, 40) for g in ("a", "b", "a")], "tmdb_id long, genre string")
    people = spark.createDataFrame([(7, "p7"), (8, "p8"), (8, "p8")], "tmdb_id long, name string")
    rates = spark.createDataFrame([("COP", 4.0)], "currency string, rate double")
    for n, df in (("movies", movies), ("movie_genres", genres), ("people", people), ("exchange", rates)):
        df.write.parquet(f"{tmp_dir}/{n}")
        spark.read.parquet(f"{tmp_dir}/{n}").createOrReplaceTempView(f"dc_{n}")
    v = {n: f"dc_{n}" for n in ("movies", "movie_genres", "people", "exchange")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for text, keys in ((QS.q1_genre_revenue(v=v), {"genre"}), (QS.q2_profitable_actors(v=v), {"person", "tmdb_id", "name"}),
                           (QS.q4_director_roi_fx(v=v), {"director"})):
            plan = spark.sql(text)._jdf.queryExecution().executedPlan().toString()
            dealt = [set(re.findall(r"(\w+)#", x)) for x in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
            pairs = [d for d in dealt if "tmdb_id" in d and d & {"genre", "person", "director"}]
            assert dealt and not pairs and all(d <= keys | {"tmdb_id"} for d in dealt), dealt
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    q1 = {r.genre: tuple(r)[1:] for r in spark.sql(QS.q1_genre_revenue(v=v)).collect()}
    s = sum(range(1, 40))
    assert q1 == {"a": (39, 20.0, 2.0 * s, 80.0, 8.0 * s), "b": (39, 20.0, 1.0 * s, 80.0, 4.0 * s)}  # copies weigh in sums, not in titles
    assert {r.tmdb_id: r.peliculas_rentables for r in spark.sql(QS.q2_profitable_actors(v=v)).collect()} == {7: 19, 8: 38}
    assert {r.director: r.peliculas for r in spark.sql(QS.q4_director_roi_fx(v=v)).collect()} == {"Ann": 26, "Bob": 39}


def test_sums_do_not_depend_on_the_order(spark):
    import random
    from fractions import Fraction

    from trilake.functions.exact import exact_sum, limbs, join_limbs, mean, total
    rng = random.Random(3)
    xs = [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randrange(-6, 13) for _ in range(5000)] + [None, 0.0, -0.0, 0.1] * 3
    df = spark.createDataFrame([(i % 3, x) for i, x in enumerate(xs)], "g int, x double")
    got = {tuple(sorted((r.g, r.s, r.m) for r in df.repartition(p).groupBy("g").agg(exact_sum(F.col("x")).alias("s"), mean(df, "x").alias("m")).collect()))
           for p in (1, 4, 64)}
    assert len(got) == 1
    for g, s, m in next(iter(got)):
        part = [x for i, x in enumerate(xs) if i % 3 == g and x is not None]
        want = float(sum(map(Fraction, part)))
        assert abs(s - want) <= 1e-9 + abs(want) * 1e-15 and abs(m - want / len(part)) <= 1e-9
    # what was added can be taken back to the last bit
    a, b = df.where("g = 0"), df.where("g < 2")
    sums = lambda d, sign: d.agg(*[F.sum(c * sign).alias(f"s{i}") for i, c in enumerate(limbs(F.col("x")))])
    back = sums(b, 1).union(sums(df.where("g = 1"), -1)).agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(4)])
    assert back.select(join_limbs([F.col(f"s{i}") for i in range(4)])).first()[0] == a.agg(exact_sum(F.col("x"))).first()[0]
    one = lambda vs: spark.createDataFrame([(v,) for v in vs], "x double").agg(exact_sum(F.col("x")).alias("s")).first().s
    assert one([None]) is None and one([1e300, 1.0]) == 1e300 and one([float("inf"), 1.0]) == float("inf") and str(one([float("nan"), 1.0])) == "nan"
    assert one([0.1, 0.2, 0.3]) == one([0.3, 0.2, 0.1]) and one([1e17, 1.0, -1e17]) == 1.0
    whole = spark.createDataFrame([(1,), (2,)], "x long")
    assert whole.agg(total(whole, "x").alias("s")).first().s == 3


def test_curated_answers_are_equal_at_any_partitioning(spark):
    import random

    from trilake.plans import questions as Q
    rng = random.Random(5)
    movies = spark.createDataFrame(
        [(i, rng.choice([1990, 1991]), rng.random() * 1e7, rng.random() * 1e10, rng.random() * 1e6, rng.random() * 300, rng.random() * 10, "a, b", "1,2", "x, y", f"t{i}")
         for i in range(3000)],
        "tmdb_id long, release_year int, revenue_usd double, revenue_cop double, profit_usd double, roi_pct double, vote_average double, genres string, cast_ids string, directors string, title string")
    people = spark.createDataFrame([(1, "p"), (2, "q")], "tmdb_id long, name string")
    reviews = spark.createDataFrame([(i % 500, rng.random() * 10) for i in range(6000)], "tmdb_id long, rating double")

    def answers(n):
        m, r = movies.repartition(n), reviews.repartition(n)
        return [sorted(map(tuple, df.collect())) for df in (
            Q.revenue_by_genre(m), Q.top_actors_rentables(m, people), Q.revenue_by_year(m), Q.roi_by_director(m),
            Q.ratings_correlations(m, r), Q.ratings_vs_revenue_sample(m, r, n=100, mode="hash"), Q.review_means(r))]

    assert answers(4) == answers(64)


def test_joins_of_large_tables_are_dealt_by_their_size(spark, tmp_dir, monkeypatch):
    from pyspark.sql import functions as F

    from trilake.operators import joins
    from trilake.plans.questions import revenue_by_genre
    from trilake.plans.trusted import genre_bridge
    titles = spark.range(5000).select(F.col("id").alias("tmdb_id"), (F.col("id") + 1).cast("decimal(18,2)").alias("revenue_usd"),
                                      (F.col("id") * 2).cast("decimal(18,2)").alias("revenue_cop"),
                                      F.when(F.col("id") % 2 == 0, "drama, noir, drama").otherwise("comedy").alias("genres"))
    titles.write.parquet(f"{tmp_dir}/titles")
    stored = spark.read.parquet(f"{tmp_dir}/titles")
    want = [tuple(r) for r in revenue_by_genre(stored, genre_bridge(stored)).collect()]
    size = joins.known_bytes(stored)
    tasks = spark.sparkContext.defaultParallelism + 9
    dealt = joins.dealt_alike("tmdb_id", stored, stored, task_bytes=-(-2 * size // tasks))
    assert all(f.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism for f in dealt)
    assert joins.dealt_alike("tmdb_id", stored, task_bytes=size) == [stored]
    unsized = spark.createDataFrame([(1,)], "tmdb_id long")
    assert joins.dealt_alike("tmdb_id", unsized) == [unsized]
    monkeypatch.setattr(joins, "JOIN_TASK_BYTES", 64)
    answer = revenue_by_genre(stored, genre_bridge(stored))
    assert "REPARTITION_BY_NUM" in answer._jdf.queryExecution().toString()
    assert [tuple(r) for r in answer.collect()] == want and len(want) == 3
