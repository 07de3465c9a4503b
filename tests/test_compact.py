"""Many small landed runs become few files; batch and stream answers stay."""

import glob

from pyspark.sql import functions as F

from trilake.sources.compact import compact_runs, drop_merged_runs, merged_runs, pack
from trilake.sources.raw_csv import land_raw, read_raw_by_header
from trilake.streaming.incremental import incremental_trusted
from trilake.plans.trusted import clean_movies

TEXT = "tmdb_id string, title string, release_year string"


def _land(spark, raw, i):
    df = spark.createDataFrame([(str(i % 7), f"t{i} \"q\",\nx", str(1990 + i % 3)), (str(100 + i), "only", None)], TEXT)
    columns = df.columns if i % 3 else df.columns[::-1]  # two classes of headers
    land_raw(df.select(*columns).coalesce(1), raw, "movies", run_ts=f"2024{i:04d}_000000")


def _raw(spark, raw):
    return sorted((tuple(r) for r in read_raw_by_header(spark, f"{raw}/movies").select("tmdb_id", "title", "release_year", "run_ts").collect()), key=str)


def test_bins():
    assert pack([("a", 5), ("b", 6), ("c", 4), ("d", 20)], 10) == [["d"], ["b", "c"], ["a"]]
    assert pack([], 10) == []


def test_runs_become_few_files(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    for i in range(24):
        _land(spark, raw, i)
    data = f"{raw}/movies"
    stream = lambda: incremental_trusted(spark, data, "movies", f"{tmp_dir}/cur", f"{tmp_dir}/ck")
    shown = lambda df: sorted((r.tmdb_id, r.title, r.release_year, r.run_ts) for r in df.collect())
    before, answer = _raw(spark, raw), shown(stream())
    assert compact_runs(spark, data) is not None
    entries, covered = merged_runs(spark, data)
    assert len(entries) == 2 and len(covered) == 23  # one bin a header; the newest run stays
    assert len(glob.glob(f"{data}/_merged/run_*/part-*.csv")) == 2
    assert _raw(spark, raw) == before and compact_runs(spark, data) is None
    # the stream sees nothing new, then only the new run
    from trilake.streaming.incremental import lake_table
    version = lake_table(spark, "movies", f"{tmp_dir}/cur").version().number
    assert shown(stream()) == answer and lake_table(spark, "movies", f"{tmp_dir}/cur").version().number == version
    for i in (24, 25, 26):
        _land(spark, raw, i)
    before = _raw(spark, raw)
    now = shown(stream())
    batch = shown(clean_movies(read_raw_by_header(spark, data)).withColumn("run_ts", F.col("run_ts").cast("string")))
    assert now == batch and now != answer
    # a later call merges small merged folders and new runs again
    assert compact_runs(spark, data) is not None and len(merged_runs(spark, data)[0]) == 2 and len(merged_runs(spark, data)[1]) == 26
    assert _raw(spark, raw) == before
    gone = drop_merged_runs(spark, data, "20240020_000000")
    assert len(gone) == 21 and _raw(spark, raw) == before and shown(stream()) == now
    assert len(glob.glob(f"{data}/run_ts=*")) == 27 - 21


def test_bins_are_bounded(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    for i in range(1, 12, 1):
        _land(spark, raw, i)
    before = _raw(spark, raw)
    compact_runs(spark, f"{raw}/movies", target_bytes=400, keep_newest=0)
    entries, covered = merged_runs(spark, f"{raw}/movies")
    assert len(entries) > 2 and all(e["bytes"] <= 400 for e in entries) and _raw(spark, raw) == before
