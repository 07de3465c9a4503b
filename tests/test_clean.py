import math

from pyspark.sql import functions as F

from trilake.functions import clean as C


def _one_col(spark, values, name="s"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def _apply(spark, values, fn):
    df = _one_col(spark, values)
    return [r["o"] for r in df.select("i", fn(F.col("s")).alias("o")).orderBy("i").collect()]


def test_nullify_literals(spark):
    vals = ["", "null", "NULL", "None", "nan", "NaN", "N/A", "n/a", "Null", "none", " N/A ", "\tN/A\t", " x "]
    out = _apply(spark, vals, C.known_text)
    assert out[:8] == [None] * 8
    # case-sensitive list: other spellings survive; trim removes spaces only, not tabs
    assert out[8:] == ["Null", "none", None, "\tN/A\t", "x"]


def test_int_recipe_matches_non_ansi_cast(spark):
    vals = ["1995", "1995.0", "12.7", ".5", "5.", " 7 ", "1e3", "99999999999", "abc", "", "+4", "-3.9",
            "nan", "NaN", "inf", None, "\t12.7\t", "\n5\n", "1 2"]
    expected = [1995, 1995, 12, 0, 5, 7, None, None, None, None, 4, -3, None, None, None, None, 12, 5, None]
    assert _apply(spark, vals, C.whole) == expected


def test_double_text(spark):
    out = _apply(spark, ["nan", "NaN", "inf", "-1", "0", "1.5", "x", None], C.real)
    assert out[0] is None and out[1] is None  # NaN mapped to null (B6)
    assert math.isinf(out[2])
    assert out[3:] == [-1.0, 0.0, 1.5, None, None]


def test_bool_text(spark):
    vals = ["TRUE", " yes ", "1", "0", "No", "y", "t", "1.0", "false", None]
    assert _apply(spark, vals, C.truth) == [True, True, True, False, False, None, None, None, False, None]


def test_normalize_list(spark):
    vals = ["Drama ,Comedy", "a,,b", "a,,,b", ",a", "a,", "N/A", "a,a", "  ", None]
    out = _apply(spark, vals, C.token_list)
    assert out == ["drama, comedy", "a,  b", "a,  , b", ", a", "a, ", None, "a, a", None, None]


def test_value_rules(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,), (5.0,)], "x double")
    assert [r[0] for r in df.select(C.not_negative(F.col("x"))).collect()] == [None, 0.0, None, 5.0]
    df = spark.createDataFrame([(-0.1,), (0.0,), (10.0,), (10.1,), (None,)], "x double")
    assert [r[0] for r in df.select(C.within(F.col("x"), 0, 10)).collect()] == [None, 0.0, 10.0, None, None]
    df = spark.createDataFrame([(None,), (100.0,), (100.1,), (300.0,), (300.1,)], "x double")
    assert [r[0] for r in df.select(C.three_way(F.col("x"))).collect()] == ["low", "low", "medium", "medium", "high"]
    df = spark.createDataFrame([(" cop ",), ("Usd",)], "s string")
    assert [r[0] for r in df.select(C.code(F.col("s"))).collect()] == ["COP", "USD"]


def test_frame_helpers_skip_absent_columns(spark):
    df = spark.createDataFrame([("1", " 2 ", "null")], "a string, b string, c string")
    out = C.typed(df, text=("c", "missing"), ints=("a", "b", "nope"), lists=("absent",))
    assert out.columns == ["a", "b", "c"]
    assert tuple(out.first()) == (1, 2, None)


def test_id_and_key_filters(spark):
    df = spark.createDataFrame([(None,), (0,), (-1,), (5,)], "tmdb_id int")
    assert [r[0] for r in df.where(C.valid_id()).collect()] == [5]
    df = spark.createDataFrame([(None,), ("",), ("r1",)], "review_id string")
    assert [r[0] for r in df.where(C.has_text("review_id")).collect()] == ["r1"]


def test_ids_are_64_bits_wide(spark):
    vals = ["2147483647", "2147483648", " 9007199254740993.0 ", "9223372036854775807", "9223372036854775808", "-.5", "5.", "1e3", "x"]
    assert _apply(spark, vals, C.identifier) == [2147483647, 2147483648, 9007199254740993, 9223372036854775807, None, 0, 5, None, None]


def test_large_ids_lose_nothing(spark, tmp_dir):
    """T1-T4, M4 and D2 with ids above 32 bits keep every row; rejected ids are counted."""
    import uuid

    from trilake.plans import questions as Q
    from trilake.plans.trusted import raw_to_trusted
    from trilake.sources.parquet import read_table
    from trilake.sources.raw_csv import ingest_all
    base, big = f"{tmp_dir}/{uuid.uuid4().hex}", 5_000_000_000
    text = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))
    ids = [str(big + i) for i in range(5)]
    ingest_all({
        "movies": text([(i, "T", "10", "1", "a", i) for i in ids] + [("0", "T", "1", "1", "a", "")], "tmdb_id title revenue_usd budget_usd genres cast_ids"),
        "tv_shows": text([(i, "S", "1") for i in ids] + [("x", "S", "1")], "tmdb_id title popularity"),
        "people": text([(i, f"P{i}") for i in ids], "tmdb_id name"),
        "movie_reviews": text([(f"r{i}", i, "5") for i in ids], "review_id tmdb_id rating"),
        "exchange": text([("COP", "4000")], "currency rate"),
    }, f"{base}/raw", run_ts="r0")
    counts = raw_to_trusted(spark, f"{base}/raw", f"{base}/trusted")
    assert {n: counts[n] for n in ("movies", "tv_shows", "people", "movie_reviews", "movie_genres")} == dict.fromkeys(
        ("movies", "tv_shows", "people", "movie_reviews", "movie_genres"), 5)
    assert (counts["movies_rejected"], counts["tv_shows_rejected"], counts["people_rejected"]) == (1, 1, 0)
    movies, people = (read_table(spark, f"{base}/trusted", n) for n in ("movies", "people"))
    assert sorted(r.actor_id for r in Q.top_actors_rentables(movies, people).collect()) == [big + i for i in range(5)]
    join = movies.join(read_table(spark, f"{base}/trusted", "movie_reviews"), "tmdb_id")
    assert join.count() == 5 and "cast(tmdb_id" not in join._jdf.queryExecution().optimizedPlan().toString()


def test_the_rules_of_a_title_stay_small_enough_to_be_compiled(spark):
    """The JVM interprets methods of more than 8000 bytes, which made cleaning six times slower."""
    import re

    from trilake.plans.trusted import movie_rows
    names = ("tmdb_id", "title", "release_year", "revenue_usd", "budget_usd", "vote_average", "vote_count", "cast_ids", "genres", "directors")
    raw = spark.createDataFrame([("1",) * len(names)], ", ".join(f"{n} string" for n in names))
    plan = movie_rows(raw)._jdf.queryExecution().executedPlan()
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan).mkString("\n")
    sizes = [int(n) for n in re.findall(r"ByteCodeStats\((\d+),", code)]
    assert sizes and max(sizes) < 8000


def test_whole_numbers_of_odd_text(spark):
    from trilake.functions.clean import whole
    want = {"1995": 1995, "1995.0": 1995, " 12.9 ": 12, "\t7.\n": 7, ".5": 0, "-.5": 0, "+3.2": 3, "-3.9": -3, "007.1": 7, "": None, ".": None, "-": None,
            "+.": None, "1e3": None, "abc": None, "1.2.3": None, "2147483647.5": 2147483647, "2147483648.5": None, "99999999999": None, "1 2": None,
            "12.5 ": None, " 5.0": None}
    df = spark.createDataFrame([(t,) for t in want], "t string").select("t", whole(F.col("t")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == want
