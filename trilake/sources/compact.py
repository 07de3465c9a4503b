"""Landing compaction: hourly runs merged into few files.

Every run is a folder with at least one file and a manifest, so a year of hourly runs is
thousands of small files. Runs with the same header are packed into bins of about
``target_bytes``, each bin is written as one merged folder, and one published version
(``sources.versions``) says which runs it stands for.

* Merged folders lie in ``_merged``, a name that readers of the raw folder skip, and keep
  every row's ``run_ts`` as a column. A file stream (ST1) therefore never sees them: the
  rows it has read are not read again, and runs it has not read yet stay where they are.
* ``read_raw_by_header`` reads merged folders in place of the runs they stand for, from the
  moment their version is published.
* ``drop_merged_runs`` removes run folders that are merged, up to a run that every stream
  has passed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilake.sources.versions import SmallFiles, Version, Zone

TARGET_BYTES = 256 << 20
FOLDER = "_merged"
#: The column that holds a merged row's run.
RUN = "run_ts"


def merged_runs(spark: SparkSession, path: str) -> tuple[list[dict], set[str]]:
    """(the merged folders of a dataset, the names of the runs they stand for)."""
    version = Zone(spark, f"{path.rstrip('/')}/{FOLDER}").version()
    entries = list(version.tables.values()) if version else []
    return entries, {r for e in entries for r in e["runs"]}


def pack(items: list[tuple[str, int]], target: int) -> list[list[str]]:
    """Items (name, bytes) in bins of at most ``target`` bytes, by first fit over falling
    sizes; what is larger than a bin has one for itself."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        for i, (used, names) in enumerate(bins):
            if used + size <= target:
                bins[i] = (used + size, [*names, name])
                break
        else:
            bins.append((size, [name]))
    return [sorted(names) for _, names in bins]


def read_merged(spark: SparkSession, path: str, entry: dict) -> DataFrame:
    """A merged folder's rows with their run."""
    from trilake.sources.raw_csv import CSV_OPTIONS
    return spark.read.options(**CSV_OPTIONS).option("enforceSchema", "false").csv(f"{path.rstrip('/')}/{FOLDER}/{entry['folder']}")


def compact_runs(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, keep_newest: int = 1) -> Version | None:
    """Merge the small runs of a dataset (all but the ``keep_newest`` newest, which may still be
    landing) and the small merged folders of earlier calls; None if nothing is worth it.
    Only lists of runs reach the driver."""
    from trilake.sources.raw_csv import CSV_OPTIONS, landed_runs, read_named
    path = path.rstrip("/")
    zone = Zone(spark, f"{path}/{FOLDER}")
    base = zone.version()
    done, covered = merged_runs(spark, path)
    name_of = lambda run: run.rstrip("/").rsplit("/", 1)[1]
    runs = {name_of(r["run"]): r for r in landed_runs(spark, path)}
    free = sorted(set(runs) - covered)[:-keep_newest or None]
    files = spark.read.format("binaryFile").load(path)  # a listing: no content is read
    sizes = {name_of(r["run"]): r["b"] for r in files.groupBy(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("run")).agg(F.sum("length").alias("b")).collect()}
    # by header: small free runs and small merged folders
    classes: dict[str, list[tuple[str, int]]] = {}
    for run in free:
        if sizes.get(run, 0) < target_bytes // 2:
            classes.setdefault(runs[run]["header"], []).append((run, sizes.get(run, 0)))
    entries = {e["folder"]: e for e in done}
    for e in done:
        if e["bytes"] < target_bytes // 2:
            classes.setdefault(e["header"], []).append((e["folder"], e["bytes"]))
    tables = {e["folder"]: e for e in done}
    for header, items in sorted(classes.items()):
        size = dict(items)
        for members in pack(items, target_bytes):
            if len(members) < 2:
                continue
            part = None
            for old in [m for m in members if m in entries]:
                rows = read_merged(spark, path, tables.pop(old))
                part = rows if part is None else part.unionByName(rows)
            new = [m for m in members if m not in entries]
            if new:
                rows = read_named(spark, [runs[m]["run"] for m in new], header)
                part = rows if part is None else part.unionByName(rows)
            total = sum(size[m] for m in members)
            folder = f"run_{uuid.uuid4().hex[:12]}"
            part.coalesce(max(1, -(-total // target_bytes))).write.options(**CSV_OPTIONS).csv(f"{path}/{FOLDER}/{folder}")
            tables[folder] = {"folder": folder, "header": header, "bytes": total,
                              "runs": sorted(new + [r for m in members if m in entries for r in entries[m]["runs"]])}
    if tables.keys() == entries.keys():
        return None
    return zone.commit(base, tables)


def drop_merged_runs(spark: SparkSession, path: str, upto: str) -> list[str]:
    """Remove the folders of merged runs up to and including the run ``upto`` (its ``run_ts``),
    which every stream over the dataset must have passed."""
    files, (_, covered) = SmallFiles(spark), merged_runs(spark, path)
    gone = [r for r in files.names(path) if r in covered and r <= f"run_ts={upto}"]
    for r in gone:
        files.remove(f"{path.rstrip('/')}/{r}")
    return gone
