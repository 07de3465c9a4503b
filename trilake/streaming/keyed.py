"""Keyed merge: a hash-bucketed current table in which a batch rewrites only its buckets.

The table holds the winner (W1) of every key seen so far. A batch's rows are dealt into the
buckets of their keys; the buckets it touches are read, merged (W1 again: the greatest row
wins, whichever came first, so the order of batches does not matter) and written to a new
folder, and one new version names that folder for those buckets and the old ones for the
rest. Nothing else is read or written, and untouched buckets keep their files.

Versions are committed as in ``sources.versions``: readers see whole versions. Each batch is
named by its source and number; a number that was applied is skipped, so a replayed batch
counts once, whatever other sources (streams) have written.

A commit also keeps what it changed: rows that came in are marked, winners that they
replaced lie beside them. ``changes`` gives both with their sign, for answers that are
maintained instead of computed anew (``plans.delta``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilake.operators.dedupe import best_per_key
from trilake.session import known_bytes, shared_dir
from trilake.sources.versions import Conflict, Version, Zone

BUCKETS = 64
#: Bytes of Parquet that a task of a merge sorts; a larger bucket is dealt to several tasks.
TASK_BYTES = 16 << 20
_OWN = ("_bucket", "_new", "_kind")


def _with_schema(old: str | None, new: T.StructType) -> T.StructType:
    """Columns seen so far, then new ones: a run may lack or add columns."""
    fields = {f.name: f for f in (T.StructType.fromJson(old).fields if old else [])}
    for f in new.fields:
        fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType(list(fields.values()))


class KeyedTable:
    """The current rows under ``root``, one for each ``key``, the greatest by ``order``."""

    def __init__(self, spark: SparkSession, root: str, key: str, order: list[str], buckets: int = BUCKETS):
        self.spark, self.zone, self.key, self.order, self.buckets = spark, Zone(spark, root), key, list(order), int(buckets)

    # -- reading -------------------------------------------------------------------------

    def version(self, number: int | None = None) -> Version | None:
        return self.zone.version(number)

    def rows(self, number: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """The current rows (of the given version, of the given buckets only); None if the
        table is empty."""
        version = self.version(number)
        if version is None:
            return None
        return self._read(version, buckets).drop("_new")

    def bucket_of(self, column: str, version: Version | None = None):
        n = (version or self.version()).meta["buckets"] if (version or self.version()) else self.buckets
        return F.pmod(F.xxhash64(column), F.lit(int(n))).cast("int")

    def _read(self, version: Version, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(version.meta["schema"]).add("_new", "boolean")
        want = None if buckets is None else set(buckets)
        paths = [f"{self.zone.root}/{t['folder']}/_kind=current/_bucket={b}" for t in version.tables.values()
                 for b in t["buckets"] if want is None or b in want]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def changes(self, number: int) -> DataFrame | None:
        """The rows that version ``number`` brought in (``_sign`` 1) and the winners that they
        replaced (-1); None if that commit changed no rows."""
        version = self.version(number)
        folder = version.meta.get("commit")
        if folder is None:
            return None
        schema = T.StructType.fromJson(version.meta["schema"]).add("_new", "boolean").add("_kind", "string")
        rows = self.spark.read.schema(schema).option("basePath", f"{self.zone.root}/{folder}").parquet(f"{self.zone.root}/{folder}")
        moved = rows.where((F.col("_kind") == "replaced") | F.col("_new"))
        return moved.withColumn("_sign", F.when(F.col("_kind") == "replaced", -1).otherwise(1)).drop("_new", "_kind", "_bucket")

    # -- writing -------------------------------------------------------------------------

    def merge(self, batch: DataFrame, source: str, number: int, attempts: int = 5) -> Version | None:
        """Merge a batch; None if it was applied before."""
        for left in reversed(range(attempts)):
            base = self.version()
            applied = dict(base.meta["applied"]) if base else {}
            if applied.get(source, -1) >= number:
                return None
            try:
                return self._merge(base, batch, applied | {source: number})
            except Conflict:  # another source was faster: merge with what it has written
                if not left:
                    raise
        return None

    def _merge(self, base: Version | None, batch: DataFrame, applied: dict) -> Version:
        n = base.meta["buckets"] if base else self.buckets
        bucket = F.pmod(F.xxhash64(self.key), F.lit(int(n))).cast("int")
        best = best_per_key(batch, self.key, *self.order, ties="*").withColumn("_bucket", bucket)
        # read twice (its buckets, then its rows), so written once
        path = shared_dir(self.spark, "keyed", uuid.uuid4().hex)
        best.write.parquet(path)
        new = self.spark.read.schema(best.schema).parquet(path)
        touched = sorted(r["_bucket"] for r in new.select("_bucket").distinct().collect())  # at most the buckets
        meta = {"buckets": n, "applied": applied, "schema": base.meta["schema"] if base else None, "commit": None}
        if not touched:
            if meta["schema"] is None:
                meta["schema"] = _with_schema(None, batch.schema).jsonValue()
            return self.zone.commit(base, base.tables if base else {}, meta)
        schema = _with_schema(meta["schema"], batch.schema)
        meta["schema"] = schema.jsonValue()
        sides, size = new.withColumn("_new", F.lit(True)), known_bytes(new)
        if base is not None:
            old = self._read(base, touched)
            size += known_bytes(old)
            sides = old.withColumns({"_new": F.lit(False), "_bucket": bucket}).unionByName(sides, allowMissingColumns=True)
        missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in sides.columns}
        sides = sides.withColumns(missing) if missing else sides
        # dealt once, by bucket and, in large buckets, by slices of their keys: the window and
        # the files need nothing else
        slices = max(1, -(-size // (len(touched) * TASK_BYTES)))
        part = F.pmod(F.xxhash64(F.lit("slice"), self.key), F.lit(slices)) if slices > 1 else F.lit(0).cast("long")
        tasks = max(1, min(len(touched), int(self.spark.conf.get("spark.sql.shuffle.partitions"))), slices * len(touched) if slices > 1 else 1)
        sides = sides.withColumn("_slice", part).repartition(tasks, "_bucket", "_slice")
        if base is None:  # one row for each key already
            kept = sides.withColumn("_kind", F.lit("current"))
        else:
            ties = sorted(set(schema.names) - {self.key} - set(self.order))
            by = [F.col(c).desc_nulls_last() for c in [*self.order, *ties] if c in schema.names]
            group = Window.partitionBy("_bucket", "_slice", self.key).orderBy(*by, F.col("_new").asc())  # an equal row brings nothing new
            placed = sides.withColumn("_place", F.row_number().over(group))
            kept = placed.where((F.col("_place") == 1) | ~F.col("_new")).withColumn(
                "_kind", F.when(F.col("_place") == 1, "current").otherwise("replaced")).drop("_place")
        kept = kept.drop("_slice")
        folder = f"data/run_{uuid.uuid4().hex[:12]}"
        kept.write.partitionBy("_kind", "_bucket").parquet(f"{self.zone.root}/{folder}")
        gone = set(touched)
        tables = {}
        for name, t in (base.tables if base else {}).items():
            rest = [b for b in t["buckets"] if b not in gone]
            if rest:
                tables[name] = {"folder": t["folder"], "buckets": rest}
        tables[folder] = {"folder": folder, "buckets": touched}
        meta["commit"] = folder
        return self.zone.commit(base, tables, meta)

    def rebucket(self, buckets: int) -> Version:
        """The same rows in another number of buckets, when the table has outgrown its own."""
        base = self.version()
        rows = self._read(base).withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(int(buckets))).cast("int"))
        folder = f"data/run_{uuid.uuid4().hex[:12]}"
        rows.withColumns({"_new": F.lit(False), "_kind": F.lit("current")}).repartition(int(buckets), "_bucket").write.partitionBy(
            "_kind", "_bucket").parquet(f"{self.zone.root}/{folder}")
        # a bucket that no key falls in has no folder
        names = self.zone.files.names(f"{self.zone.root}/{folder}/_kind=current")
        held = sorted(int(x.partition("=")[2]) for x in names if x.startswith("_bucket="))
        return self.zone.commit(base, {folder: {"folder": folder, "buckets": held}}, base.meta | {"buckets": int(buckets), "commit": None})
