"""Reading one large quoted CSV file with many tasks.

A quoted field may hold line breaks, so a task that starts inside a file cannot tell a
record's end from a line break by looking at its own part; Spark therefore reads such a
file (``multiLine``) in one task. But a line begins a record exactly if an even number of
quotes stands before it. So

1. the file is read as plain lines in ordinary splits, and the quotes of each split are
   counted: one number a split;
2. the parity before each split is the running sum of those numbers along the file;
3. the splits are read again, each with its parity: lines are put together to records where
   the parity says so. Only the pieces at a split's borders (a record's beginning at its
   end, the rest at its start) are shuffled, at most two a split, and joined;
4. records are parsed by Spark's own CSV parser (``from_csv``).

The files must be RFC 4180 text: quotes only around whole fields, doubled inside them (what
``land_raw`` and common writers produce), not compressed. The result equals the
``multiLine`` read.
"""

from __future__ import annotations

import csv
import io
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trilake.session import shared_dir

#: Splits whose parities are broadcast (about 100 bytes each); beyond, lines are dealt by split.
MAX_SPLITS = 1 << 20
_PIECES = "f long, s long, kind int, first boolean, text string"
#: Kinds of piece: a whole record, a rest at a split's start, a beginning at its end.
WHOLE, REST, BEGINNING = 0, 1, 2


def _lines(spark: SparkSession, paths) -> DataFrame:
    """value, f (file), s (start of the split), i (order)."""
    return (spark.read.option("lineSep", "\n").option("recursiveFileLookup", "false").text(paths)
            .select("value", F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s")))


def split_parities(lines: DataFrame) -> DataFrame:
    """f, s, odd: whether a split begins inside a quoted field."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    counted = lines.groupBy("f", "s").agg(F.sum(F.pmod(quotes, F.lit(2))).alias("n"))
    before = Window.partitionBy("f").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("f", "s", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("odd"))


def _joined(values: pa.Array, starts: np.ndarray) -> pa.Array:
    """The values between every two starts, joined by line breaks."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values), "\n")


class _Assembler:
    """Lines of one split after the other, in order, to pieces."""

    def __init__(self, columns: list[str]):
        self.columns = columns
        self.split = None

    def batches(self, batches):
        for b in batches:
            if b.num_rows:
                f, s = b.column("f").to_numpy(), b.column("s").to_numpy()
                change = np.flatnonzero((f[1:] != f[:-1]) | (s[1:] != s[:-1])) + 1
                for at, to in zip([0, *change.tolist()], [*change.tolist(), b.num_rows]):
                    if (f[at], s[at]) != self.split:
                        yield from self.end()
                        self.split, self.odd = (f[at], s[at]), bool(b.column("odd")[at].as_py())
                        self.held, self.kind, self.top = [], REST if self.odd else WHOLE, int(s[at]) == 0
                    yield from self.lines(b.column("value").slice(at, to - at))
        yield from self.end()

    def lines(self, values):
        n = len(values)
        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
        before = (np.concatenate([[0], np.cumsum(quotes)]) + self.odd) % 2
        starts = np.flatnonzero(before[:-1] == 0)
        self.odd = bool(before[-1])
        if not len(starts):
            self.held.append(values)
            return
        if starts[0] or self.held:  # what was open ends before the first start
            self.held.append(values.slice(0, int(starts[0])))
            yield from self.close()
        self.kind = WHOLE
        # the last record is open until the next start
        if len(starts) > 1:
            cut = int(starts[-1])
            yield from self.emit(_joined(values.slice(0, cut), starts), WHOLE)
        self.held = [values.slice(int(starts[-1]), n - int(starts[-1]))]

    def close(self, kind=None):
        values = pa.concat_arrays([v.cast(pa.string()) for v in self.held]) if self.held else pa.array([], pa.string())
        self.held = []
        if len(values):
            yield from self.emit(_joined(values, np.array([0, len(values)])), self.kind if kind is None else kind)

    def end(self):
        if self.split is not None and self.held:
            # an open quote at a split's end: this is only a record's beginning (or its middle)
            yield from self.close(BEGINNING if self.odd and self.kind == WHOLE else None)

    def emit(self, texts, kind):
        texts = pc.replace_substring_regex(texts, r"\r$", "") if kind == WHOLE else texts
        if kind == WHOLE:
            texts = texts.filter(pc.not_equal(texts, ""))
            if not len(texts):
                return
        first = np.zeros(len(texts), bool)
        if self.top and kind != REST:
            first[0], self.top = True, False
            if kind == WHOLE:
                self.check(texts[0].as_py())
        n = len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, self.split[0])), pa.array(np.full(n, self.split[1])), pa.array(np.full(n, kind, np.int32)), pa.array(first), texts],
            names=["f", "s", "kind", "first", "text"])

    def check(self, header: str):
        names = next(csv.reader(io.StringIO(header.removeprefix("﻿"), newline="")), [])
        if names != self.columns:
            raise ValueError(f"CSV header {names} does not conform to {self.columns}")


def split_records(spark: SparkSession, paths, columns: list[str], max_splits: int = MAX_SPLITS) -> DataFrame:
    """f (file), text: every record of the files but their headers."""
    lines = _lines(spark, paths)
    parity = split_parities(lines)
    path = shared_dir(spark, "csv-splits", uuid.uuid4().hex)
    parity.write.parquet(path)
    parity = spark.read.schema(parity.schema).parquet(path)
    if parity.count() <= max_splits:  # the lines stay where they are, in their order
        dealt = lines.join(F.broadcast(parity), ["f", "s"])
    else:
        dealt = lines.withColumn("i", F.monotonically_increasing_id()).join(parity, ["f", "s"]).repartition("f", "s").sortWithinPartitions("f", "s", "i")
    pieces = dealt.select("value", "f", "s", "odd").mapInArrow(lambda batches: _Assembler(columns).batches(batches), _PIECES)
    whole = pieces.where(F.col("kind") == WHOLE).select("f", "first", "text")
    # pieces of records that cross a border: a beginning and the rests that follow it
    order = Window.partitionBy("f").orderBy("s", "kind")
    chain = pieces.where(F.col("kind") != WHOLE).withColumn("c", F.sum(F.when(F.col("kind") == BEGINNING, 1).otherwise(0)).over(order))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("s", "kind", "text"))), lambda p: p["text"])
    crossing = chain.groupBy("f", "c").agg(F.bool_or("first").alias("first"), F.regexp_replace(F.array_join(parts, "\n"), "\r$", "").alias("text"))
    return whole.unionByName(crossing.drop("c")).where("NOT first").select("f", "text")


def read_csv_split(spark: SparkSession, paths, columns: list[str], options: dict, base_path: str | None = None) -> DataFrame:
    """The files' rows, all strings, with ``columns`` as their header must name them; with
    ``base_path`` the partition columns (``run_ts``) too. Equal to a ``multiLine`` read."""
    records = split_records(spark, paths, columns)
    parse = {k: v for k, v in options.items() if k not in ("header", "enforceSchema")}
    places = ", ".join(f"_c{i} STRING" for i in range(len(columns)))
    rows = records.select("f", F.from_csv("text", places, parse).alias("r")).select(
        "f", *[F.col(f"r._c{i}").alias(c) for i, c in enumerate(columns)])
    if base_path is None:
        return rows.drop("f")
    files = spark.read.format("binaryFile").option("basePath", base_path).load(paths)  # a listing: no content is read
    extra = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    files = files.select(F.xxhash64("_metadata.file_path").alias("f"), *extra)
    return rows.join(files, "f").drop("f")
