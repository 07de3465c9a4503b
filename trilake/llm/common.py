"""Helpers shared by the corpus operators: scratch tables, Arrow text blocks, word hashing.

Every operator treats ``(doc_id, xxhash64(text))`` as a document's key, so a null or
repeated ``doc_id`` is an ordinary case: rows that share doc_id *and* text are one
document and get one result each, rows that share only the doc_id stay apart.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from trilake.session import shared_dir

#: Bytes of text that one vectorised step works on (about 100 bytes of memory for each).
BLOCK_BYTES = 1 << 20

MULT = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240607)
#: A random odd 64-bit value per byte (0 stays 0), the same in every task.
BYTE_HASH = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Word bytes after lower-casing A-Z: digits, letters, everything outside ASCII.
WORD_LUT = np.zeros(256, np.uint8)
WORD_LUT[0x30:0x3A] = np.arange(0x30, 0x3A)
WORD_LUT[0x61:0x7B] = np.arange(0x61, 0x7B)
WORD_LUT[0x41:0x5B] = np.arange(0x61, 0x7B)
WORD_LUT[0x80:] = np.arange(0x80, 0x100)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: the cut in the
    lineage that survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def document_key(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, _th, text): the columns the operators read, null texts empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(t).alias("_th"),
                       t.alias("text"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the frame does not have (case does not tell them apart)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def same_document(left: DataFrame, right: DataFrame):
    """Join condition on the document key; null ids match each other."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["_th"] == right["_th"])


def text_blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
                max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most ``max_bytes`` of text, or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lens, dtype=np.int64)
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all 64."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), MULT, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """Words of a block of texts: ``[0-9a-z\\x80-\\xff]+`` runs of the A-Z-lower-cased UTF-8."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = ()):
        self.low = WORD_LUT[raw]
        inside = self.low != 0
        nonempty = offsets[:-1][offsets[1:] > offsets[:-1]]
        before = np.zeros(len(raw), bool)
        before[1:] = inside[:-1]
        before[nonempty] = False
        after = np.zeros(len(raw), bool)
        after[:-1] = inside[1:]
        after[nonempty[1:] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        n = np.bincount(self.doc, minlength=len(offsets) - 1)
        self.count = n
        self.first = np.concatenate([[0], np.cumsum(n)])
        self.hash, self.prefix = self._hashes(inside, prefixes)

    def _hashes(self, inside, prefixes):
        if not len(self.starts):
            return np.zeros(0, np.uint64), [np.zeros(0, np.uint64) for _ in prefixes]
        lens = self.ends - self.starts
        at = np.concatenate([[0], np.cumsum(lens)[:-1]])
        pos = np.arange(int(lens.sum())) - np.repeat(at, lens)
        part = BYTE_HASH[self.low[inside]] * powers(int(lens.max()))[pos]
        out = mix(np.add.reduceat(part, at))
        return out, [mix(np.add.reduceat(np.where(pos < p, part, np.uint64(0)), at)) for p in prefixes]

    def text(self, i: int, j: int) -> str:
        """Words i..j-1, one space between them."""
        return b" ".join(self.low[a:b].tobytes() for a, b in
                         zip(self.starts[i:j], self.ends[i:j])).decode("utf-8", "replace")


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k word hashes (the last k-1 places are not set)."""
    out = np.zeros(len(hashes), np.uint64)
    m = len(hashes) - k + 1
    for j in range(k):
        if m > 0:
            out[:m] = out[:m] * MULT + hashes[j:j + m]
    return mix(out)


def sliding_min(keys: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive keys."""
    have, out = 1, keys
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < w:
        out = np.minimum(out[:len(out) - (w - have)], out[w - have:])
    return out


#: What operators remember in a Python worker from task to task.
_remembered: list[dict] = []


def remembered() -> dict:
    """An empty memory for an operator's tasks; the ``lean`` tasks of others empty it."""
    _remembered.append({})
    return _remembered[-1]


def _hand_back() -> None:
    """Returns the memory that this process has freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def _forget() -> None:
    if any(_remembered):
        for memory in _remembered:
            memory.clear()
        _hand_back()


def lean(task: Callable) -> Callable:
    """``task`` (batches in, batches out) that begins without what other operators remember in
    its Python worker and leaves no freed memory there. Spark gives a worker to one stage after
    the other, so whatever a stage leaves counts in all later ones."""
    def run(batches):
        _forget()
        try:
            yield from task(batches)
        finally:
            _hand_back()

    return run


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def range_sorted(df: DataFrame, order: list, name: str, running: str | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order`` in a scratch table, with its place:
    ``_pid`` (partition), ``_i`` (row in the partition) and, for ``running``, ``_before``
    (that column's sum over the partition's earlier rows). Ties are cut anywhere, so equal
    keys spread over partitions instead of meeting in one."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    keys = [*order, F.col("_salt")]
    part = salted.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_salt")
    columns = part.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in part.schema)

    def place(batches):
        i, total = 0, 0
        for b in batches:
            size = b.num_rows
            arrays = [b.column(c) for c in columns] + [pa.array(np.arange(i, i + size))]
            if running:
                v = b.column(running).to_numpy(zero_copy_only=False).astype(np.int64)
                c = np.cumsum(v) + total
                arrays.append(pa.array(c - v))
                total = int(c[-1]) if size else total
            i += size
            yield pa.RecordBatch.from_arrays(arrays, names=columns + ["_i"] + (["_before"] if running else []))

    out = part.mapInArrow(place, schema + ", _i long" + (", _before long" if running else ""))
    return materialise(out.withColumn("_pid", F.spark_partition_id()), name)


def word_cuts(raw: np.ndarray, max_bytes: int) -> list[int]:
    """Places that cut one text into pieces of about ``max_bytes``, never inside a word."""
    cuts, at = [0], 0
    while len(raw) - at > max_bytes:
        to = at + max_bytes
        while to < len(raw):
            gap = np.flatnonzero(WORD_LUT[raw[to:to + 65536]] == 0)
            if len(gap):
                to += int(gap[0])
                break
            to += 65536
        at = min(to, len(raw))
        cuts.append(at)
    if cuts[-1] < len(raw) or len(cuts) == 1:
        cuts.append(len(raw))
    return cuts


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows (but the last) of input sorted by ``keys``, cut only
    between groups."""
    held: list[pa.RecordBatch] = []
    have = 0
    for batch in batches:
        held.append(batch)
        have += batch.num_rows
        if have < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            v = table.column(k).to_numpy()
            change |= v[1:] != v[:-1]
        cut = np.flatnonzero(change)
        if len(cut):  # the last group may go on in the next batch
            yield table.slice(0, int(cut[-1]) + 1)
            held = table.slice(int(cut[-1]) + 1).combine_chunks().to_batches()
        have = sum(b.num_rows for b in held)
    if have:
        yield pa.Table.from_batches(held).combine_chunks()
