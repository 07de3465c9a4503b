"""ST1: incremental raw -> trusted for newly landed files (Structured Streaming).

A file stream over a dataset's raw folder picks up only new files. Raw files are
positional, and runs may differ in their columns, so the stream reads *places*
(``_c0``, ``_c1``, ...) with each row's file; inside ``foreachBatch`` the rows of each run
get the names of that run's landed header (its ``_columns`` manifest), runs are united by
name, cleaned, and cut to one row per key (W1). A run without a manifest stops the job.

Where a batch's winners go, a batch counts once:

* ``KeyedTable`` (the default of ``incremental_trusted``): merged into a hash-bucketed
  current table, of which only the batch's buckets are rewritten;
* a change log (``run_incremental`` and ``current_table``): one folder per batch, compacted
  by ``snapshot``.

Spark numbers the batches of a checkpoint from 0, so a lost or reset checkpoint starts
again at 0. Batches are therefore named by the stream's own id and number, and the log gives
each a number of its own that never runs backwards: nothing is overwritten or taken for
old. There is no streaming state to keep. ``trigger(availableNow)`` handles what has landed,
``files_per_batch`` files at a time, and stops: what an hourly scheduler runs. Checkpoints are
in the shared folder.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilake.operators.dedupe import best_per_key
from trilake.session import shared_dir
from trilake.sources.raw_csv import CSV_OPTIONS, header_names, land_raw, landed_runs
from trilake.sources.versions import Conflict, SmallFiles
from trilake.streaming.keyed import BUCKETS, KeyedTable

FILES_PER_BATCH = 1000
_PLACE = re.compile(r"^(\d{12})(?:\.([0-9a-f-]+)\.(\d+))?$")
_RUN = "run_ts="


def _named(batch: DataFrame, headers: dict[str, list[str]]) -> DataFrame:
    """Positional rows with the column names of their run, in one pass: a column's place is
    chosen by the row's run. A row of a run without a header stops the job."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for run, names in headers.items():
        if run.rsplit("/", 1)[1].startswith(_RUN):
            groups.setdefault(tuple(names), []).append(run)
    which = F.when(F.lit(False), F.lit(-1))
    for i, members in enumerate(groups.values()):
        which = which.when(F.col("run").isin(members), i)
    which = which.otherwise(F.raise_error(F.concat(F.lit("no landed header for "), F.col("run"))).cast("int"))
    rows = batch.withColumn("_header", which).where("_header >= 0")
    places: dict[str, dict[int, int]] = {}
    for i, names in enumerate(groups):
        for place, name in enumerate(names):
            places.setdefault(name, {})[i] = place
    columns = []
    for name, at in places.items():
        if len(set(at.values())) == 1 and len(at) == len(groups):  # at one place in every run
            columns.append(F.col(f"_c{at[0]}").alias(name))
            continue
        value = F.when(F.lit(False), F.lit(None).cast("string"))
        for i, place in at.items():
            value = value.when(F.col("_header") == i, F.col(f"_c{place}"))
        columns.append(value.alias(name))
    return rows.select(*columns, F.substring(F.substring_index("run", "/", -1), len(_RUN) + 1, 1 << 30).alias("run_ts"))


def _stream_batches(spark: SparkSession, raw_dir: str, checkpoint_dir: str, files_per_batch: int,
                    handle: Callable[[DataFrame, dict, str, int], None]) -> None:
    """Call ``handle(rows, headers, stream id, batch number)`` for the files landed under
    ``raw_dir`` (a dataset folder) since the last run."""
    headers = {r["run"].rstrip("/"): header_names(r["header"]) for r in landed_runs(spark, raw_dir)}
    if not headers:
        raise ValueError(f"no landed run with a header under {raw_dir}")
    width = max(len(h) for h in headers.values())
    places = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    stream = (spark.readStream.schema(places).options(**CSV_OPTIONS).option("enforceSchema", "true")
              .option("maxFilesPerTrigger", int(files_per_batch)).csv(f"{raw_dir.rstrip('/')}/*")
              .withColumn("run", F.expr("left(_metadata.file_path, length(_metadata.file_path) - length(substring_index(_metadata.file_path, '/', -1)) - 1)")))
    known = threading.Event()
    ids: list[str] = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        known.wait(600)
        if not batch.isEmpty():
            handle(batch, headers, ids[0], int(batch_id))

    query = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    ids.append(str(query.id))  # kept in the checkpoint: another one after a reset
    known.set()
    query.awaitTermination()


def run_incremental(spark: SparkSession, raw_dir: str, clean: Callable[[DataFrame], DataFrame], key: str,
                    order: list[str], changes_dir: str, checkpoint_dir: str,
                    files_per_batch: int = FILES_PER_BATCH) -> None:
    """Add the winners of every file landed under ``raw_dir`` since the last run to the
    change log."""

    def handle(batch, headers, stream, number):
        rows = clean(_named(batch, headers))
        place = _log_place(spark, changes_dir, stream, number)
        best_per_key(rows, key, *order, ties="*").write.mode("overwrite").parquet(f"{changes_dir}/batch_id={place}")

    _stream_batches(spark, raw_dir, checkpoint_dir, files_per_batch, handle)


def run_keyed(spark: SparkSession, raw_dir: str, clean: Callable[[DataFrame], DataFrame], table: KeyedTable,
              checkpoint_dir: str, files_per_batch: int = FILES_PER_BATCH) -> None:
    """Merge every file landed under ``raw_dir`` since the last run into a keyed table."""
    _stream_batches(spark, raw_dir, checkpoint_dir, files_per_batch,
                    lambda batch, headers, stream, number: table.merge(clean(_named(batch, headers)), stream, number))


def _log_place(spark: SparkSession, changes_dir: str, stream: str, number: int) -> int:
    """The log's own number of a stream's batch: the one reserved for it before (a replay
    writes the same folder), else the next."""
    files = SmallFiles(spark)
    folder = f"{changes_dir.rstrip('/')}/_places"
    while True:
        taken = [m for m in map(_PLACE.match, files.names(folder)) if m]
        for m in taken:
            if m[2] is not None and (m[2], int(m[3])) == (stream, number):
                return int(m[1])
        logged = [int(n.partition("=")[2]) for n in files.names(changes_dir) if n.startswith("batch_id=")]
        place = max([-1, *logged, *(int(m[1]) for m in taken)]) + 1
        try:
            files.add(f"{folder}/{place:012d}", "")  # the number, once for all writers
            files.add(f"{folder}/{place:012d}.{stream}.{number}", "")
            return place
        except Conflict:
            continue


def _found(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None if its path does not exist; other errors stay errors."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _changes(spark: SparkSession, changes_dir: str, snapshots_dir: str | None) -> DataFrame:
    """The newest snapshot and the batches after it."""
    log = spark.read.option("mergeSchema", "true").parquet(changes_dir)
    manifests = _found(lambda: spark.read.schema("path string, upto long").json(f"{snapshots_dir}/manifests/*")) if snapshots_dir else None
    newest = manifests.orderBy(F.desc("upto")).first() if manifests is not None else None
    if newest is None:
        return log
    after = log.where(F.col("batch_id") > newest["upto"])
    return spark.read.parquet(newest["path"]).unionByName(after, allowMissingColumns=True)


def current_table(spark: SparkSession, changes_dir: str, key: str, order: list[str],
                  snapshots_dir: str | None = None) -> DataFrame:
    """The trusted rows: W1 over snapshot and newer batches, so the work does not grow with
    the number of runs."""
    rows = _changes(spark, changes_dir, snapshots_dir).drop("batch_id")
    return best_per_key(rows, key, *order, ties="*")


def snapshot(spark: SparkSession, changes_dir: str, key: str, order: list[str], snapshots_dir: str) -> str:
    """Compact the log into a new snapshot folder and then add its manifest, a new file that
    names the last batch it covers. Nothing is replaced, so readers always find a whole
    snapshot; older ones and covered batches can be expired by the platform."""
    log = _changes(spark, changes_dir, snapshots_dir)
    upto = log.agg(F.max("batch_id")).first()[0]
    if upto is None:
        return ""
    ordered = best_per_key(log.withColumn("batch_id", F.lit(int(upto)).cast(log.schema["batch_id"].dataType)), key, *order, ties="*")
    path = f"{snapshots_dir.rstrip('/')}/upto={int(upto)}-{uuid.uuid4().hex[:8]}"
    ordered.write.parquet(path)
    (spark.createDataFrame([(path, int(upto))], "path string, upto long").coalesce(1)
     .write.json(f"{snapshots_dir.rstrip('/')}/manifests/{path.rsplit('/', 1)[1].replace('=', '-')}"))
    return path


def lake_table(spark: SparkSession, name: str, root: str, buckets: int = BUCKETS) -> KeyedTable:
    """The keyed current table of a lake table."""
    from trilake.plans.trusted import ROW_CLEANERS
    _, key, order = ROW_CLEANERS[name]
    return KeyedTable(spark, root, key, list(order), buckets)


def incremental_trusted(spark: SparkSession, raw_dir: str, name: str, current_dir: str, checkpoint_dir: str,
                        files_per_batch: int = FILES_PER_BATCH, buckets: int = BUCKETS) -> DataFrame:
    """ST1 for one lake table (movies, tv_shows, people, movie_reviews, exchange): the new
    files are merged into the keyed table under ``current_dir``, whose rows are returned.
    Columns that follow from the chosen row (the TV bucket) are added to it; what needs other
    tables is in ``incremental_tables``."""
    from trilake.plans.trusted import ROW_CLEANERS, with_bucket
    table = lake_table(spark, name, current_dir, buckets)
    run_keyed(spark, raw_dir, ROW_CLEANERS[name][0], table, checkpoint_dir, files_per_batch)
    rows = table.rows()
    return with_bucket(rows) if name == "tv_shows" else rows


def incremental_tables(spark: SparkSession, raw_prefix: str, out_prefix: str, code: str = "COP",
                       names: tuple[str, ...] = ("movies", "tv_shows", "people", "movie_reviews", "exchange")) -> dict[str, DataFrame]:
    """ST1 for the whole lake: the trusted tables of the batch job, with finance columns,
    the genre bridge and only reviews of known titles."""
    from trilake.operators.finance import financial_metrics
    from trilake.operators.joins import keep_known
    from trilake.plans.trusted import genre_bridge
    out = {n: incremental_trusted(spark, f"{raw_prefix.rstrip('/')}/{n}", n, f"{out_prefix}/{n}/current", f"{out_prefix}/{n}/checkpoint")
           for n in names}
    out["movies"] = financial_metrics(out["movies"], out["exchange"], code)
    out["movie_genres"] = genre_bridge(out["movies"])
    out["movie_reviews"] = keep_known(out["movie_reviews"], out["movies"], "tmdb_id")
    return out


# ---------------------------------------------------------------- contract query

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")


def clean_events(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("event_id").try_cast("long").alias("event_id"),
        F.try_to_timestamp(F.col("ts")).alias("ts"),
        F.col("user_id").try_cast("long").alias("user_id"),
        F.trim(F.col("event_type")).alias("event_type"),
        F.col("value").try_cast("double").alias("value"),
    )


def q_incremental_latest(spark: SparkSession, d: str) -> DataFrame:
    """Land events as raw CSV in three runs (by event time; null times in the first), each
    with its own column order, process them run by run, return the latest event per user."""
    base = shared_dir(spark, "incremental", uuid.uuid4().hex)
    raw, changes, ckpt = f"{base}/raw", f"{base}/changes", f"{base}/checkpoint"
    ev = spark.read.parquet(f"{d.rstrip('/')}/events.parquet").select(*EVENT_COLUMNS)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    third = F.lit(0) if lo is None else F.coalesce(F.when(F.col("ts") < F.lit(lo + (hi - lo) / 3), 0).when(
        F.col("ts") < F.lit(lo + 2 * (hi - lo) / 3), 1).when(F.col("ts").isNotNull(), 2), F.lit(0))
    for i in range(3):
        columns = EVENT_COLUMNS[i:] + EVENT_COLUMNS[:i]
        land_raw(ev.where(third == i).select(*columns), raw, "events", run_ts=f"run{i}")
        run_incremental(spark, f"{raw}/events", clean_events, "user_id", ["ts", "event_id"], changes, ckpt)
    return current_table(spark, changes, "user_id", ["ts", "event_id"]).select("event_id", "user_id", "event_type", "value")


ORACLE_INCREMENTAL = """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1"""
