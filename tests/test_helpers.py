"""Helpers that the composite plans use only indirectly."""

from pyspark.sql import functions as F

from tests.conftest import rows
from trilake.functions import clean as C
from trilake.operators import attach_scalar


def test_attach_scalar_defaults_and_empty(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    one = spark.createDataFrame([(7.5, "x")], "rate double, tag string")
    assert rows(attach_scalar(df, one)) == [(1, 7.5, "x"), (2, 7.5, "x")]
    empty = one.where("false")
    assert rows(attach_scalar(df, empty, ["rate"], defaults={"rate": 1.0})) == [(1, 1.0), (2, 1.0)]


def test_one_projection_types_a_table(spark):
    df = spark.createDataFrame([(" N/A ", "-3", "YES", " Drama,,Comedy ")], "t string, neg string, b string, genres string")
    r = C.typed(df, text=("t", "missing"), doubles=("neg",), bools=("b",), lists=("genres",)).first()
    assert (r["t"], r["neg"], r["b"], r["genres"]) == (None, -3.0, True, "drama,  comedy")


def test_lazy_trusted_tables_equal_written_job(spark, tmp_dir):
    import os

    from trilake.plans.trusted import raw_to_trusted, trusted_tables
    from trilake.sources.parquet import read_table
    from trilake.sources.raw_csv import read_raw
    files = {
        "movies": "tmdb_id,title,release_year,budget_usd,revenue_usd,genres\n1,A,1990,10,30,Drama\n1,A0,1980,1,1,x\n2,B,1991,5,,Comedy\n",
        "tv_shows": "tmdb_id,title,popularity\n1,S,150\n",
        "people": "tmdb_id,name,popularity\n10,P,1\n",
        "movie_reviews": "review_id,tmdb_id,rating,created_at\nr1,1,5,x\nr2,9,5,x\n",
        "exchange": "currency,rate\ncop,4000\n",
    }
    for name, text in files.items():
        d = f"{tmp_dir}/raw/{name}/run_ts=1"
        os.makedirs(d)
        with open(f"{d}/f.csv", "w") as f:
            f.write(text)
    raw_to_trusted(spark, f"{tmp_dir}/raw", f"{tmp_dir}/trusted")
    lazy = trusted_tables({n: read_raw(spark, f"{tmp_dir}/raw/{n}") for n in files})
    for name, df in lazy.items():
        written = read_table(spark, f"{tmp_dir}/trusted", name)
        cols = sorted(c for c in df.columns if c != "run_ts")
        assert rows(df.select(cols)) == rows(written.select(cols)), name
