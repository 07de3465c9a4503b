"""Raw zone: RFC 4180 CSV files, all strings.

Writers of the raw zone quote fields and double embedded quotes, and fields may
contain newlines, so reads need ``multiLine`` and ``escape='"'``. A landed dataset
is a folder of runs: ``raw/<name>/run_ts=<yyyymmdd_HHMMSS>/part-*.csv``; partition
discovery turns ``run_ts`` into a column, so "newest landing" is a plain column.
"""

from __future__ import annotations

import csv
import datetime
import io
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilake.sources.compact import RUN, merged_runs, read_merged
from trilake.sources.csv_split import read_csv_split

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}


def run_stamp(now: datetime.datetime | None = None) -> str:
    """Landing timestamp, ``yyyymmdd_HHMMSS``."""
    return (now or datetime.datetime.now()).strftime("%Y%m%d_%H%M%S")


def read_raw(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """Every CSV under ``path`` (all landed runs), header row, all strings.

    No schema inference (a full extra pass over the data in the reference's case).
    ``with_file`` adds the source file name from the ``_metadata`` column."""
    df = spark.read.options(**CSV_OPTIONS).option("recursiveFileLookup", "false").csv(path)
    if with_file:
        df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return df


def header_line(names: list[str]) -> str:
    """A header by the CSV rules: names with commas, quotes or line breaks are quoted."""
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(names)
    return out.getvalue()


def header_names(line: str) -> list[str]:
    """The names of a header line."""
    return next(csv.reader(io.StringIO(line, newline="")), [])


def folder_header(spark: SparkSession, folder: str) -> str:
    """Header line of a folder's files: Spark reads the head of one file, nothing else."""
    return header_line(spark.read.options(**CSV_OPTIONS).csv(folder).columns)


def run_manifests(spark: SparkSession, path: str) -> DataFrame:
    """(run folder, header) for every run landed by ``land_raw``: the hidden
    ``_columns`` manifest written next to the data, one tiny file per run."""
    m = (spark.read.option("recursiveFileLookup", "true").text(f"{path.rstrip('/')}/*/_columns", wholetext=True)
         .select(F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/_columns/[^/]*$", 1).alias("run"),
                 F.regexp_replace("value", r"\r?\n$", "").alias("header")))
    return m


def read_raw_by_header(spark: SparkSession, path: str, split_large: int | None = None) -> DataFrame:
    """U2 (safe variant): Spark's CSV scan maps columns by the position of the FIRST
    file's header, so a run landed with another column set is silently misassigned.
    Runs are grouped by their header, each group is read with its own, and the groups are
    united by name (missing columns -> null). ``path`` is the dataset folder; ``run_ts=``
    sub-folders still become a column (``basePath``).

    Runs landed by ``land_raw`` carry a ``_columns`` manifest. Of a run without one (landed
    by other tools) the head of one file is read, and the scan itself checks every file's
    header against it (``enforceSchema=false``) and fails on a difference. Only the list of
    runs with their headers reaches the driver, never a list of files.

    Runs with a file larger than ``split_large`` bytes (default: the session's split size) are
    read by many tasks a file (``csv_split``), the others by one task a file. Runs that were
    merged (``sources.compact``) are read from their merged folder."""
    merged, covered = merged_runs(spark, path)
    is_merged = lambda run: run.rstrip("/").rsplit("/", 1)[1] in covered
    headers = {r["run"]: r["header"] for r in landed_runs(spark, path)}
    files = spark.read.format("binaryFile").load(path)  # a listing: no content is read
    folders = files.groupBy(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("run")).agg(F.max("length").alias("largest"))
    above = split_above(spark) if split_large is None else split_large
    groups: dict[tuple[str, bool], list[str]] = {}
    largest = {r["run"]: r["largest"] for r in folders.collect()}
    for run in largest.keys() | headers.keys():
        if is_merged(run):
            continue
        header = headers[run] if run in headers else folder_header(spark, run)
        groups.setdefault((header, largest.get(run, 0) > above), []).append(run)
    out = None
    for (header, large), runs in sorted(groups.items()):
        if large:
            part = read_csv_split(spark, sorted(runs), header_names(header), CSV_OPTIONS, base_path=path)
        else:
            part = spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false").option("basePath", path).csv(sorted(runs))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    for entry in merged:  # in place of the runs they stand for
        part = read_merged(spark, path, entry)
        if out is not None and RUN in out.columns:
            part = part.withColumn(RUN, F.col(RUN).cast(out.schema[RUN].dataType))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return read_raw(spark, path) if out is None else out


def read_named(spark: SparkSession, runs: list[str], header: str) -> DataFrame:
    """The rows of runs with one header, with each row's ``run_ts`` as text."""
    rows = spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false").option("recursiveFileLookup", "true").csv(runs)
    return rows.select(*[F.col(f"`{n}`") for n in header_names(header)], F.regexp_extract("_metadata.file_path", r"/run_ts=([^/]*)/[^/]*$", 1).alias(RUN))


def split_above(spark: SparkSession) -> int:
    """File size from which on a file is worth several tasks: the session's split size."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def landed_runs(spark: SparkSession, path: str) -> list:
    """Manifest rows of a dataset (one for each run). None if no run has one; any other
    failure to read them is an error."""
    try:
        return run_manifests(spark, path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def land_raw(df: DataFrame, raw_prefix: str, name: str, run_ts: str | None = None, rows_per_file: int = 1_000_000) -> str:
    """Land a dataset in the raw zone under a new run folder; never overwrites
    (``errorifexists``). Values are written as text, quoted per RFC 4180. A file has
    ``rows_per_file`` rows at most."""
    ts = run_ts or run_stamp()
    path = f"{raw_prefix.rstrip('/')}/{name}/run_ts={ts}"
    (df.select([F.col(c).cast("string").alias(c) for c in df.columns])
       .write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).options(**CSV_OPTIONS).csv(path))
    # Hidden manifest with the run's header line (readers skip "_" paths); lets the
    # header-safe read group runs without probing the data files.
    header = header_line(df.columns)
    (df.sparkSession.createDataFrame([(header,)], "value string").coalesce(1)
       .write.mode("overwrite").text(f"{path}/_columns"))
    return path


def ingest_all(sources: dict[str, DataFrame], raw_prefix: str, run_ts: str | None = None) -> dict[str, str]:
    """Land every source dataset of one run, in a fixed order (files, people,
    reviews, rates). Missing sources are skipped with a warning, not an error."""
    ts = run_ts or run_stamp()
    out = {}
    for name in ("movies", "tv_shows", "people", "movie_reviews", "exchange"):
        src = sources.get(name)
        if src is None:
            print(f"[WARN] missing source: {name}")
            continue
        out[name] = land_raw(src, raw_prefix, name, ts)
    return out


def q_raw_split_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Contract query for S1: customers with quotes, commas and line breaks in their text are
    landed as one file and read back by many tasks."""
    from trilake.session import shared_dir
    raw = shared_dir(spark, "raw_split", uuid.uuid4().hex)
    c = spark.read.parquet(f"{d.rstrip('/')}/customer.parquet")
    note = F.concat(F.lit('say "'), F.col("c_name"), F.lit('",\n'), F.repeat(F.lit("line\n"), (F.col("c_custkey") % 4).cast("int")), F.lit('"'))
    land_raw(c.select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, note).alias("note"), "c_name").coalesce(1), raw, "customer", "run0",
             rows_per_file=0)
    return read_raw_by_header(spark, f"{raw}/customer", split_large=0).select("c_custkey", "note", "c_name")


ORACLE_RAW_SPLIT = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CASE WHEN c_custkey % 5 <> 0 THEN 'say "' || c_name || '",' || chr(10) || repeat('line' || chr(10), CAST(c_custkey % 4 AS INTEGER)) || '"' END AS note
FROM customer"""


def q_raw_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Contract query for S1/S9/U2: land all orders as two raw runs whose files carry
    different column sets and orders, then read the zone back grouped by header."""
    from trilake.session import shared_dir
    raw = shared_dir(spark, "raw_roundtrip", uuid.uuid4().hex)
    o = spark.read.parquet(f"{d.rstrip('/')}/orders.parquet")
    land_raw(o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey"), raw, "orders", "run0")
    land_raw(o.where(~(F.col("o_orderstatus") == "F") | F.col("o_orderstatus").isNull())
              .select("o_custkey", "o_orderstatus", "o_orderkey"), raw, "orders", "run1")
    back = read_raw_by_header(spark, f"{raw}/orders")
    return back.select("o_orderkey", "o_custkey", "o_orderstatus")


ORACLE_RAW_ROUNDTRIP = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS o_orderstatus
FROM orders"""
