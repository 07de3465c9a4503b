"""ST1: incremental (streaming) latest-per-key equals the batch answer."""

import uuid

from pyspark.sql import functions as F

from trilake.operators.dedupe import best_per_key
from trilake.sources.raw_csv import land_raw
from trilake.streaming.incremental import clean_events, current_table, run_incremental

ORDER = ["ts", "event_id"]


def test_incremental_equals_batch_and_late_file_can_win(spark, tmp_dir):
    base = f"{tmp_dir}/{uuid.uuid4().hex}"
    run1 = spark.createDataFrame(
        [(1, "2024-01-02 00:00:00", 7, "a", 1.0), (2, "2024-01-01 00:00:00", 8, "b", 2.0)],
        "event_id long, ts string, user_id long, event_type string, value double")
    # a late-landed file with an OLDER event for user 7 and a newer one for user 8
    run2 = spark.createDataFrame(
        [(3, "2023-12-31 00:00:00", 7, "c", 3.0), (4, "2024-01-05 00:00:00", 8, "d", 4.0),
         (5, "2024-01-05 00:00:00", 8, "e", 5.0)],
        "event_id long, ts string, user_id long, event_type string, value double")
    raw = f"{base}/raw"
    for i, df in enumerate((run1, run2)):
        land_raw(df, raw, "events", run_ts=f"r{i}")
        run_incremental(spark, f"{raw}/events", clean_events, "user_id", ORDER, f"{base}/changes", f"{base}/ckpt")
    inc = {r["user_id"]: r["event_id"] for r in current_table(spark, f"{base}/changes", "user_id", ORDER).collect()}
    all_rows = run1.unionByName(run2).withColumn("ts", F.to_timestamp("ts"))
    batch = {r["user_id"]: r["event_id"] for r in best_per_key(all_rows, "user_id", "ts", ties="event_id").collect()}
    assert inc == batch == {7: 1, 8: 5}
    # rerunning with nothing new is a no-op
    run_incremental(spark, f"{raw}/events", clean_events, "user_id", ORDER, f"{base}/changes", f"{base}/ckpt")
    again = {r["user_id"]: r["event_id"] for r in current_table(spark, f"{base}/changes", "user_id", ORDER).collect()}
    assert again == inc


def test_incremental_movies_equals_batch_clean(spark, tmp_dir):
    import os

    from trilake.plans.trusted import clean_movies
    from trilake.sources.raw_csv import read_raw
    from trilake.streaming.incremental import incremental_trusted
    header = "tmdb_id,title,release_year,vote_count,popularity,revenue_usd,budget_usd,genres\n"
    runs = [
        '1,A,1990,10,1.0,100,50,"Drama ,Comedy"\n2,B,,5,2.0,-1,10,N/A\n0,Z,1990,1,1,1,1,x\n',
        "1,A2,1991,1,0.5,200,50,drama\n2,B2,2000,1,1.0,5,1,action\n3,C,1980,1,1.0,,,\n1,A3,1991,1,0.1,1,1,x\n",
    ]
    base = f"{tmp_dir}/{uuid.uuid4().hex}"
    for i, text in enumerate(runs):
        d = f"{base}/raw/movies/run_ts=r{i}"
        os.makedirs(d)
        with open(f"{d}/part.csv", "w") as f:
            f.write(header + text)
        os.makedirs(f"{d}/_columns")
        with open(f"{d}/_columns/part-0.txt", "w") as f:
            f.write(header)
        inc = incremental_trusted(spark, f"{base}/raw/movies", "movies", f"{base}/changes", f"{base}/ckpt")
    batch = clean_movies(read_raw(spark, f"{base}/raw/movies").drop("run_ts"))
    cols = ["tmdb_id", "title", "release_year", "vote_count", "popularity", "revenue_usd", "budget_usd", "genres"]
    got = sorted(tuple(r) for r in inc.select(cols).collect())
    want = sorted(tuple(r) for r in batch.select(cols).collect())
    assert got == want
    assert {r[0]: r[1] for r in got} == {1: "A2", 2: "B2", 3: "C"}


def test_snapshot_compaction_keeps_answer(spark, tmp_dir):
    from trilake.streaming.incremental import snapshot
    base = f"{tmp_dir}/{uuid.uuid4().hex}"
    raw = f"{base}/raw"
    batches = [
        [(1, "2024-01-02 00:00:00", 7, "a", 1.0), (2, "2024-01-01 00:00:00", 8, "b", 2.0)],
        [(3, "2024-01-03 00:00:00", 7, "c", 3.0)],
        [(4, "2024-01-04 00:00:00", 8, "d", 4.0), (5, "2023-01-01 00:00:00", 9, "e", 5.0)],
    ]
    for i, rows_ in enumerate(batches):
        df = spark.createDataFrame(rows_, "event_id long, ts string, user_id long, event_type string, value double")
        land_raw(df, raw, "events", run_ts=f"r{i}")
        run_incremental(spark, f"{raw}/events", clean_events, "user_id", ORDER, f"{base}/changes", f"{base}/ckpt")
        if i == 1:
            assert "/upto=1-" in snapshot(spark, f"{base}/changes", "user_id", ORDER, f"{base}/snap")
    full = {r["user_id"]: r["event_id"] for r in current_table(spark, f"{base}/changes", "user_id", ORDER).collect()}
    snap = {r["user_id"]: r["event_id"] for r in
            current_table(spark, f"{base}/changes", "user_id", ORDER, f"{base}/snap").collect()}
    assert full == snap == {7: 3, 8: 4, 9: 5}
    snapshot(spark, f"{base}/changes", "user_id", ORDER, f"{base}/snap")
    again = {r["user_id"]: r["event_id"] for r in
             current_table(spark, f"{base}/changes", "user_id", ORDER, f"{base}/snap").collect()}
    assert again == full


def test_runs_with_other_column_orders_do_not_shift(spark, tmp_dir):
    import pytest

    from trilake.streaming.incremental import incremental_tables, incremental_trusted
    raw = f"{tmp_dir}/raw"
    text = "tmdb_id string, title string, release_year string"
    land_raw(spark.createDataFrame([("1", "A", "1990")], text), raw, "movies", run_ts="r0")
    land_raw(spark.createDataFrame([("2", "B", "2000")], text).select("release_year", "tmdb_id", "title"), raw, "movies", run_ts="r1")
    land_raw(spark.createDataFrame([("3", "C", "x")], "tmdb_id string, title string, extra string"), raw, "movies", run_ts="r2")
    got = incremental_trusted(spark, f"{raw}/movies", "movies", f"{tmp_dir}/c", f"{tmp_dir}/k", files_per_batch=1)
    assert sorted((r.tmdb_id, r.release_year, r.title) for r in got.collect() if r.tmdb_id < 3) == [(1, 1990, "A"), (2, 2000, "B")]
    # the whole lake, with finance columns, bridge and known titles
    lake = f"{tmp_dir}/lake"
    land_raw(spark.createDataFrame([("1", "30", "10", "Drama")], "tmdb_id string, revenue_usd string, budget_usd string, genres string"), lake, "movies", run_ts="r0")
    land_raw(spark.createDataFrame([("r1", "1", "5"), ("r2", "9", "5")], "review_id string, tmdb_id string, rating string"), lake, "movie_reviews", run_ts="r0")
    land_raw(spark.createDataFrame([("COP", "4"), ("cop", "3")], "currency string, rate string"), lake, "exchange", run_ts="r0")
    out = incremental_tables(spark, lake, f"{tmp_dir}/out", names=("movies", "movie_reviews", "exchange"))
    m = out["movies"].first()
    assert (m.profit_usd, m.roi_pct, m.revenue_cop) == (20.0, 300.0, 120.0)
    assert [r.review_id for r in out["movie_reviews"].collect()] == ["r1"] and out["movie_genres"].first().genre == "drama"
    # a run without a header stops the job instead of guessing
    import os
    os.makedirs(f"{raw}/movies/run_ts=r9")
    with open(f"{raw}/movies/run_ts=r9/x.csv", "w") as f:
        f.write("release_year,tmdb_id\n1999,7\n")
    with pytest.raises(Exception, match="no landed header"):
        incremental_trusted(spark, f"{raw}/movies", "movies", f"{tmp_dir}/c", f"{tmp_dir}/k")


EVENT = "event_id long, ts string, user_id long, event_type string, value double"


def _users(table):
    return {r["user_id"]: r["event_id"] for r in table.collect()}


def test_a_reset_checkpoint_loses_nothing(spark, tmp_dir):
    """Batch numbers start again at 0 with a new checkpoint: the log must neither overwrite
    its folders nor take the new batches for ones that a snapshot covers."""
    from trilake.streaming.incremental import snapshot
    raw, changes, snap = f"{tmp_dir}/raw", f"{tmp_dir}/changes", f"{tmp_dir}/snap"
    land_raw(spark.createDataFrame([(1, "2024-01-01 00:00:00", 1, "a", 1.0)], EVENT), raw, "events", run_ts="r0")
    run_incremental(spark, f"{raw}/events", clean_events, "user_id", ORDER, changes, f"{tmp_dir}/ckpt0")
    snapshot(spark, changes, "user_id", ORDER, snap)
    land_raw(spark.createDataFrame([(2, "2024-01-02 00:00:00", 2, "b", 1.0)], EVENT), raw, "events", run_ts="r1")
    run_incremental(spark, f"{raw}/events", clean_events, "user_id", ORDER, changes, f"{tmp_dir}/ckpt1", files_per_batch=1)
    assert _users(current_table(spark, changes, "user_id", ORDER, snap)) == {1: 1, 2: 2}
    land_raw(spark.createDataFrame([(3, "2024-01-03 00:00:00", 3, "c", 1.0)], EVENT), raw, "events", run_ts="r2")
    run_incremental(spark, f"{raw}/events", clean_events, "user_id", ORDER, changes, f"{tmp_dir}/ckpt0")  # the old stream goes on
    assert _users(current_table(spark, changes, "user_id", ORDER, snap)) == {1: 1, 2: 2, 3: 3}
    assert _users(current_table(spark, changes, "user_id", ORDER)) == {1: 1, 2: 2, 3: 3}


def test_a_replayed_batch_counts_once(spark, tmp_dir):
    from trilake.sources.versions import SmallFiles
    from trilake.streaming.incremental import _log_place
    assert [_log_place(spark, tmp_dir, s, n) for s, n in (("aa", 0), ("aa", 1), ("bb", 0), ("aa", 1), ("aa", 0))] == [0, 1, 2, 1, 0]
    assert len([n for n in SmallFiles(spark).names(f"{tmp_dir}/_places") if not n.startswith(".")]) == 6


def _files(table, version=None):
    version = table.version(version)
    return {b: t["folder"] for t in version.tables.values() for b in t["buckets"]}


def test_keyed_merge_rewrites_only_touched_buckets(spark, tmp_dir):
    import os

    from trilake.streaming.keyed import KeyedTable
    table = KeyedTable(spark, tmp_dir, "k", ["v"], buckets=8)
    assert table.rows() is None
    rows = lambda r: spark.createDataFrame(r, "k long, v long, t string")
    table.merge(rows([(i, i, "old") for i in range(100)]), "s", 0)
    before = _files(table)
    stamp = {f: os.path.getmtime(f"{tmp_dir}/{f}") for f in set(before.values())}
    table.merge(rows([(3, 50, "new"), (3, 40, "less"), (7, 1, "late")]), "s", 1)
    after = _files(table)
    changed = {b for b in after if after[b] != before[b]}
    assert 1 <= len(changed) <= 2 and {f: os.path.getmtime(f"{tmp_dir}/{f}") for f in stamp} == stamp
    got = {r.k: (r.v, r.t) for r in table.rows().collect()}
    assert got == {i: (i, "old") for i in range(100)} | {3: (50, "new")}
    # what the commit changed: the new winner in, the old one out; the late row is neither
    assert sorted((r._sign, r.k, r.v, r.t) for r in table.changes(2).collect()) == [(-1, 3, 3, "old"), (1, 3, 50, "new")]
    assert table.changes(1).count() == 100
    assert {r.k: r.v for r in table.rows(1).collect()}[3] == 3  # a pinned reader
    assert table.merge(rows([(3, 99, "again")]), "s", 1) is None  # applied before
    assert table.merge(rows([(200, 1, "other")]), "t", 0) is not None  # another stream has numbers of its own
    assert table.rows().count() == 101
    # the same row again changes nothing; a run may add or lack columns; an empty batch is a commit
    assert table.merge(rows([(3, 50, "new")]), "s", 2).meta["commit"] and table.changes(4).count() == 0
    table.merge(spark.createDataFrame([(3, 60, 1.5)], "k long, v long, extra double"), "s", 3)
    assert [tuple(r) for r in table.rows().where("k = 3").select("v", "t", "extra").collect()] == [(60, None, 1.5)]
    assert table.merge(rows([]), "s", 4).meta["commit"] is None and table.changes(6) is None
    table.rebucket(3)
    assert table.rows().count() == 101 and len(_files(table)) == 3
    table.merge(rows([(3, 70, "x"), (None, 1, "no key")]), "s", 5)
    assert table.rows().count() == 102 and table.zone.expire(1) and table.rows().count() == 102


def test_keyed_merge_meets_a_faster_writer(spark, tmp_dir, monkeypatch):
    from trilake.streaming.keyed import KeyedTable
    one, two = (KeyedTable(spark, tmp_dir, "k", ["v"], buckets=2) for _ in range(2))
    row = lambda k, v: spark.createDataFrame([(k, v)], "k long, v long")
    one.merge(row(1, 1), "s", 0)
    real, once = one._merge, []

    def slow(base, batch, applied):
        if not once:
            once.append(two.merge(row(1, 9), "t", 0))
        return real(base, batch, applied)

    monkeypatch.setattr(one, "_merge", slow)
    one.merge(row(1, 5), "s", 1)
    assert [tuple(r) for r in one.rows().collect()] == [(1, 9)] and one.version().meta["applied"] == {"s": 1, "t": 0}


def test_order_of_landings_does_not_matter(spark, tmp_dir):
    import random

    from trilake.streaming.keyed import KeyedTable
    rng = random.Random(1)
    rows_ = [(rng.randrange(20), rng.choice([None, 1, 2, 3]), rng.choice("abc")) for _ in range(200)]
    df = lambda r: spark.createDataFrame(r, "k long, v long, t string")
    want = sorted(tuple(r) for r in best_per_key(df(rows_), "k", "v", ties="*").collect())
    for i, parts in enumerate(([rows_[:70], rows_[70:90], rows_[90:]], [rows_[90:], rows_[:70], rows_[70:90]])):
        table = KeyedTable(spark, f"{tmp_dir}/{i}", "k", ["v"], buckets=4)
        for j, part in enumerate(parts):
            table.merge(df(part), "s", j)
        assert sorted(tuple(r) for r in table.rows().select("k", "v", "t").collect()) == want


def test_quoted_header_names_do_not_shift(spark, tmp_dir):
    from trilake.sources.raw_csv import read_raw_by_header
    raw = f"{tmp_dir}/raw"
    odd = 'a, "b"'
    land_raw(spark.createDataFrame([("x", "1", "2024-01-01 00:00:00")], ["odd", "user_id", "ts"]).withColumnRenamed("odd", odd), raw, "events", run_ts="r0")
    land_raw(spark.createDataFrame([("2", "y")], ["user_id", "other"]), raw, "events", run_ts="r1")
    got = {r["user_id"]: r[odd] for r in read_raw_by_header(spark, f"{raw}/events").collect()}
    assert got == {"1": "x", "2": None}
    seen = []

    def clean(df):
        seen.append(df.columns)
        return df.select(F.col("user_id").cast("long").alias("user_id"))

    run_incremental(spark, f"{raw}/events", clean, "user_id", [], f"{tmp_dir}/c", f"{tmp_dir}/k")
    assert odd in seen[0] and _ids(current_table(spark, f"{tmp_dir}/c", "user_id", [])) == {1, 2}


def _ids(table):
    return {r["user_id"] for r in table.collect()}


def test_runs_are_named_in_one_pass(spark):
    """Neither a job to list the runs nor a scan for each header: one projection over the batch."""
    from trilake.streaming.incremental import _named
    batch = spark.createDataFrame([("1", "A", None, "/x/run_ts=r0"), ("B", "2", "z", "/x/run_ts=r1"), ("3", "C", None, "/x/run_ts=r0")],
                                  "_c0 string, _c1 string, _c2 string, run string")
    headers = {"/x/run_ts=r0": ["id", "title"], "/x/run_ts=r1": ["title", "id", "extra"]}
    spark.sparkContext.setJobGroup("naming", "naming")
    named = _named(batch, headers)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("naming")
    assert "Union" not in named._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.id, r.title, r.extra, r.run_ts) for r in named.collect()) == [("1", "A", None, "r0"), ("2", "B", "z", "r1"), ("3", "C", None, "r0")]
    import pytest
    with pytest.raises(Exception, match="no landed header"):
        _named(batch, {"/x/run_ts=r0": ["id", "title"]}).collect()


def test_a_large_bucket_is_merged_by_several_tasks(spark, tmp_dir, monkeypatch):
    import glob

    from trilake.streaming import keyed
    monkeypatch.setattr(keyed, "TASK_BYTES", 1 << 10)
    table = keyed.KeyedTable(spark, f"{tmp_dir}/t", "k", ["v"], buckets=2)
    table.merge(spark.range(4000).selectExpr("id AS k", "id % 7 AS v", "concat('first ', id) AS text"), "s", 0)
    table.merge(spark.range(3000, 6000).selectExpr("id AS k", "id % 5 + 2 AS v", "concat('second ', id) AS text"), "s", 1)
    got = {r.k: (r.v, r.text) for r in table.rows().collect()}
    want = {k: (k % 7, f"first {k}") for k in range(4000)}
    for k in range(3000, 6000):
        want[k] = max(want.get(k, (-1, "")), (k % 5 + 2, f"second {k}"))
    assert got == want and table.rows().count() == 6000
    signs = {r["_sign"]: r["count"] for r in table.changes(2).groupBy("_sign").count().collect()}
    gone = sum(1 for k in range(3000, 4000) if (k % 5 + 2, f"second {k}") > (k % 7, f"first {k}"))
    assert signs == {1: 2000 + gone, -1: gone}
    folder = table.version().meta["commit"]
    assert any(len(glob.glob(f"{f}/*.parquet")) > 1 for f in glob.glob(f"{tmp_dir}/t/{folder}/_kind=current/_bucket=*"))
