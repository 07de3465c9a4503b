import json
import os

import pytest

from tests.conftest import rows
from trilake.sources import jdbc
from trilake.sources.parquet import read_table, write_table
from trilake.sources.raw_csv import folder_header, land_raw, read_raw, read_raw_by_header
from trilake.sources.rates import read_rates_json


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_quoting_and_newlines(spark, tmp_dir):
    _write(f"{tmp_dir}/t/a.csv", 'id,txt\n1,"say ""hi"""\n2,"two\nlines"\n3,\n')
    got = {r["id"]: r["txt"] for r in read_raw(spark, f"{tmp_dir}/t").collect()}
    assert got == {"1": 'say "hi"', "2": "two\nlines", "3": None}


def test_header_grouped_union_fixes_positional_mapping(spark, tmp_dir):
    _write(f"{tmp_dir}/t/run_ts=1/a.csv", "id,name\n1,x\n")
    _write(f"{tmp_dir}/t/run_ts=2/b.csv", "name,id,extra\ny,2,e\n")
    assert folder_header(spark, f"{tmp_dir}/t/run_ts=2") == "name,id,extra"
    got = rows(read_raw_by_header(spark, f"{tmp_dir}/t"), "id", "name", "extra", "run_ts")
    assert got == [("1", "x", None, 1), ("2", "y", "e", 2)]
    naive = rows(read_raw(spark, f"{tmp_dir}/t"), "id", "name")   # positional mapping is wrong
    assert naive != [("1", "x"), ("2", "y")]


def test_land_raw_never_overwrites_and_reads_back(spark, tmp_dir):
    df = spark.createDataFrame([(1, 'a "q"', 2.5)], "id int, s string, v double")
    p = land_raw(df, f"{tmp_dir}/raw", "things", run_ts="20240101_000000")
    assert p.endswith("things/run_ts=20240101_000000")
    with pytest.raises(Exception):
        land_raw(df, f"{tmp_dir}/raw", "things", run_ts="20240101_000000")
    land_raw(df, f"{tmp_dir}/raw", "things", run_ts="20240101_010000")
    back = read_raw(spark, f"{tmp_dir}/raw/things")
    assert back.count() == 2 and "run_ts" in back.columns
    assert {r["s"] for r in back.collect()} == {'a "q"'}


def test_rates_json_flatten(spark, tmp_dir):
    doc = {"base": "USD", "date": "2024-01-01", "rates": {"COP": 4000.5, "EUR": 0.9}}
    _write(f"{tmp_dir}/r/x.json", json.dumps(doc) + "\n")
    got = rows(read_rates_json(spark, f"{tmp_dir}/r"), "currency", "rate", "base", "date")
    assert got == [("COP", 4000.5, "USD", "2024-01-01"), ("EUR", 0.9, "USD", "2024-01-01")]


def test_write_table_counts_with_observation(spark, tmp_dir):
    df = spark.range(42).selectExpr("id", "id % 3 AS part")
    assert write_table(df, tmp_dir, "t", partition_by=["part"]) == 42
    assert read_table(spark, tmp_dir, "t").where("part = 1").count() == 14


def test_jdbc_options():
    o = jdbc.read_options("jdbc:mysql://h/db", table="people", fetch_size=jdbc.PEOPLE_FETCH,
                          partition_column="tmdb_id", lower=1, upper=1000, num_partitions=8)
    assert o == {"url": "jdbc:mysql://h/db", "fetchsize": "1000", "dbtable": "people",
                 "partitionColumn": "tmdb_id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "8"}
    o = jdbc.read_options("u", query="SELECT * FROM movie_reviews", fetch_size=jdbc.REVIEWS_FETCH,
                          partition_column="id", lower=0, upper=9, num_partitions=2)
    assert o["dbtable"].startswith("(SELECT * FROM movie_reviews)") and o["fetchsize"] == "200"
    with pytest.raises(ValueError):
        jdbc.read_options("u", table="a", query="b")
    with pytest.raises(ValueError):
        jdbc.read_options("u", table="a", partition_column="x")
    w = jdbc.write_options("u", "people", batch_size=500)
    assert w["batchsize"] == "500" and w["truncate"] == "true"
    with pytest.raises(ValueError):
        jdbc.write_options("u", "people", batch_size=5000)


def test_bucketed_tables_join_without_shuffle(spark, tmp_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(2000).selectExpr("id AS tmdb_id", "id * 2 AS x")
        b = spark.range(6000).selectExpr("id % 2000 AS tmdb_id", "id AS y")
        assert write_table(a, tmp_dir, "movies", bucket_by="tmdb_id", buckets=8) == 2000
        assert write_table(b, tmp_dir, "movie_reviews", bucket_by="tmdb_id", buckets=8) == 6000
        ma, mb = read_table(spark, tmp_dir, "movies"), read_table(spark, tmp_dir, "movie_reviews")
        j = ma.join(mb, "tmdb_id")
        assert j.count() == 6000
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_header_grouping_uses_manifests_and_probes_foreign_files(spark, tmp_dir):
    from trilake.sources.raw_csv import run_manifests
    raw = f"{tmp_dir}/raw"
    land_raw(spark.createDataFrame([("1", "x")], "id string, name string"), raw, "t", run_ts="1")
    land_raw(spark.createDataFrame([("y", "2", "e")], "name string, id string, extra string"), raw, "t", run_ts="2")
    _write(f"{raw}/t/run_ts=3/foreign.csv", "extra,id\nf,3\n")          # landed by another tool
    assert sorted(r["header"] for r in run_manifests(spark, f"{raw}/t").collect()) == ["id,name", "name,id,extra"]
    got = rows(read_raw_by_header(spark, f"{raw}/t"), "id", "name", "extra", "run_ts")
    assert got == [("1", "x", None, 1), ("2", "y", "e", 2), ("3", None, "f", 3)]


def test_files_of_a_run_with_another_header_fail_loudly(spark, tmp_dir):
    _write(f"{tmp_dir}/t/run_ts=1/a.csv", "id,name\n1,x\n")
    _write(f"{tmp_dir}/t/run_ts=1/b.csv", "name,id\ny,2\n")
    with pytest.raises(Exception, match="CSV header|does not conform"):
        read_raw_by_header(spark, f"{tmp_dir}/t").collect()


def test_indented_rates_document(spark, tmp_dir):
    _write(f"{tmp_dir}/r/x.json", json.dumps({"base": "USD", "date": "2024-01-01", "rates": {"COP": 4000.5}}, indent=2))
    assert rows(read_rates_json(spark, f"{tmp_dir}/r"), "currency", "rate") == [("COP", 4000.5)]
    _write(f"{tmp_dir}/bad/x.json", "no document")
    with pytest.raises(Exception):
        read_rates_json(spark, f"{tmp_dir}/bad").collect()


def test_a_bucket_is_one_file_and_a_rewrite_drops_the_buckets(spark, tmp_dir):
    import glob
    wide = spark.range(4000).selectExpr("id AS tmdb_id", "id AS x").repartition(40)
    write_table(wide, tmp_dir, "movies", bucket_by="tmdb_id", buckets=16)
    assert len(glob.glob(f"{tmp_dir}/movies/part-*")) == 16
    write_table(wide, tmp_dir, "movies")
    other = spark.range(10).selectExpr("id AS tmdb_id", "id AS y")
    assert read_table(spark, tmp_dir, "movies").join(other, "tmdb_id").count() == 10


def test_no_machine_local_scratch_on_a_cluster(monkeypatch):
    from trilake import session

    class Conf:
        def __init__(self, master):
            self.values = {"spark.master": master}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Spark:
        conf = Conf("spark://host:7077")

    with pytest.raises(ValueError):
        session.shared_dir(Spark())


def test_raw_files_are_bounded(spark, tmp_dir):
    import glob
    land_raw(spark.range(100).coalesce(1), f"{tmp_dir}/raw", "t", run_ts="1", rows_per_file=30)
    assert len(glob.glob(f"{tmp_dir}/raw/t/run_ts=1/part-*.csv")) == 4
