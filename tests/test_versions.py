"""Atomic publish of several tables, pinned readers, rollback, expiry and the version cache."""

import pytest
from pyspark.sql import functions as F

from trilake.sources.parquet import curated_cache, load_curated, read_table, read_tables
from trilake.sources.versions import Conflict, SmallFiles, Zone


def publish(spark, root, value, names=("a", "b")):
    draft = Zone(spark, root).draft()
    for n in names:
        draft.write(spark.range(value).withColumn("v", F.lit(value)), n)
    return draft.publish()


def test_readers_see_whole_versions(spark, tmp_dir):
    zone = Zone(spark, tmp_dir)
    assert zone.version() is None
    publish(spark, tmp_dir, 3)
    old = zone.pinned()
    draft = zone.draft()
    draft.write(spark.range(5).withColumn("v", F.lit(5)), "a")
    # half a rewrite: nobody sees it, the draft itself does
    assert read_table(spark, tmp_dir, "a").count() == 3 and draft.table("a").count() == 5
    draft.write(spark.range(5).withColumn("v", F.lit(5)), "b")
    draft.publish()
    assert {n: t.count() for n, t in read_tables(spark, tmp_dir, ("a", "b")).items()} == {"a": 5, "b": 5}
    assert [old.table(n).count() for n in "ab"] == [3, 3] and old.rows() == {"a": 3, "b": 3}


def test_a_failed_job_changes_nothing(spark, tmp_dir):
    publish(spark, tmp_dir, 3)
    draft = Zone(spark, tmp_dir).draft()
    draft.write(spark.range(9), "a")
    with pytest.raises(Exception):
        draft.write(spark.range(9).select(F.assert_true(F.col("id") < 5).isNull().alias("x")), "b")
    assert Zone(spark, tmp_dir).numbers() == [1] and read_table(spark, tmp_dir, "a").count() == 3


def test_two_writers_from_one_version(spark, tmp_dir):
    publish(spark, tmp_dir, 1)
    first, second = Zone(spark, tmp_dir).draft(), Zone(spark, tmp_dir).draft()
    for d, n in ((first, 2), (second, 4)):
        d.write(spark.range(n), "a")
    first.publish()
    with pytest.raises(Conflict):
        second.publish()
    assert read_table(spark, tmp_dir, "a").count() == 2
    assert [n for n in SmallFiles(spark).names(f"{tmp_dir}/_versions") if n.startswith(".") and not n.endswith(".crc")] == []


def test_rollback_and_expiry(spark, tmp_dir):
    for value in (1, 2, 3):
        publish(spark, tmp_dir, value)
    zone = Zone(spark, tmp_dir)
    zone.rollback(1)
    assert read_table(spark, tmp_dir, "b").count() == 1 and zone.numbers() == [1, 2, 3, 4]
    gone = zone.expire(keep=1)  # version 4 names the folders of version 1
    assert len(gone) == 4 and zone.numbers() == [4] and read_table(spark, tmp_dir, "a").count() == 1
    publish(spark, tmp_dir, 7, names=("a",))  # other tables stay
    assert read_table(spark, tmp_dir, "b").count() == 1 and read_table(spark, tmp_dir, "a").count() == 7


def test_bucketed_tables_of_a_version(spark, tmp_dir):
    for n in (10, 20):
        draft = Zone(spark, tmp_dir).draft()
        draft.write(spark.range(n), "t", bucket_by="id", buckets=4)
        draft.publish()
    assert read_table(spark, tmp_dir, "t").count() == 20 and Zone(spark, tmp_dir).pinned(1).table("t").count() == 10


def test_cache_follows_the_published_version(spark, tmp_dir):
    publish(spark, tmp_dir, 3, ("k",))
    first = load_curated(spark, tmp_dir, "k")
    assert first.count() == 3 and first.storageLevel.useMemory and load_curated(spark, tmp_dir, "k") is first
    publish(spark, tmp_dir, 8, ("k",))
    second = load_curated(spark, tmp_dir, "k")
    assert second.count() == 8 and not first.storageLevel.useMemory
    assert curated_cache.release(tmp_dir) == 1 and not second.storageLevel.useMemory
    assert not load_curated(spark, tmp_dir, "k", cache=False).storageLevel.useMemory


def test_jobs_publish_all_tables_at_once(spark, tmp_dir):
    """A reader opened before a rewrite of the whole trusted zone sees its six old tables."""
    from trilake.plans.trusted import raw_to_trusted
    from trilake.sources.raw_csv import land_raw
    raw, trusted = f"{tmp_dir}/raw", f"{tmp_dir}/trusted"

    def land(run, titles):
        land_raw(spark.createDataFrame([(str(i), "9", "3", "a,b") for i in titles], "tmdb_id string, revenue_usd string, budget_usd string, genres string"), raw, "movies", run)
        land_raw(spark.createDataFrame([(str(i), "x", "1") for i in titles], "tmdb_id string, title string, popularity string"), raw, "tv_shows", run)
        land_raw(spark.createDataFrame([(str(i), "x") for i in titles], "tmdb_id string, name string"), raw, "people", run)
        land_raw(spark.createDataFrame([(f"r{i}", str(i), "5") for i in titles], "review_id string, tmdb_id string, rating string"), raw, "movie_reviews", run)
        land_raw(spark.createDataFrame([(f"C{i}", "2") for i in titles], "currency string, rate string"), raw, "exchange", run)

    land("r0", range(1, 4))
    raw_to_trusted(spark, raw, trusted)
    old = Zone(spark, trusted).pinned()
    land("r1", range(4, 9))
    counts = raw_to_trusted(spark, raw, trusted)
    names = ("movies", "movie_genres", "people", "movie_reviews", "exchange", "tv_shows")
    assert [old.table(n).count() for n in names] == [3, 6, 3, 3, 3, 3]
    assert [read_table(spark, trusted, n).count() for n in names] == [counts[n] for n in names] == [8, 16, 8, 8, 8, 8]
