"""Exact removal of repeated byte strings with suffix arrays.

A byte goes if a ``length``-byte string that covers it also starts earlier (a smaller
doc_id, or the same document). The whole input's suffix array would show these strings as
neighbours; it is built in parts that never have to be merged:

1. Every string of ``length`` bytes picks the smallest hash of its k-grams as its anchor.
   Equal strings pick equal anchors at the same offset, so all of them meet under one
   anchor, and each string belongs to one anchor only. An anchor's strings are
   consecutive: together they are one segment of the text (about 130 bytes).
2. Segments are pre-aggregated by (anchor, content) where they are read, then dealt out by
   anchor. Of identical segments only the first occurrence goes on; the others' strings
   all occur earlier. An anchor with a single content is settled. An anchor that a sample
   of the documents shows with many contents is dealt out by content as well, so that a
   phrase in a third of all documents fills many buckets; the sample decides only where
   segments meet, never what is found.
3. The differing segments of an anchor are concatenated and suffix-sorted by linear
   grouping (``suffix_order``). Equal strings are neighbours there; all but the earliest
   are marked.
4. An anchor with more than ``split_rows`` different segments is split on the cluster into
   strings that reach far to the right of the anchor and those that reach far to its left,
   each keyed by the bytes that they then share; again and again, until it is small or its
   strings are equal.

Segment contents are compared by a digest of 126 bits beside the anchor's 32: a polynomial
modulo 2**64 and two modulo the prime 2**31 - 1, for which two different segments of m bytes
agree with at most (m / 2**31)**2 of the pairs of bases, whatever the texts are. The sorted
strings are compared byte by byte.

Cases: null and empty texts have no bytes; null doc_ids come first; rows that share the
doc_id are in the order of their text hash, and rows that share doc_id and text are one
document whose result each of them gets; texts shorter than ``length`` keep all bytes; an
empty table gives no rows; other columns are ignored (``remove_repeats``: kept).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import BYTE_HASH, MULT, document_key, fresh, lean, materialise, mix, powers, sliding_min, text_blocks, utf8
from .suffix_order import suffix_order

GRAM = 32
#: Longest stretch of one text that is scanned at a time (places fit in 24 bits).
STRETCH = 1 << 20
#: Bytes of text whose segments a task pre-aggregates before it passes them on.
GATHER_BYTES = 1 << 23
#: Bytes of text that a task cuts into segments at a time; each takes about 100 bytes of memory.
SCAN_BYTES = 1 << 18
#: Bytes of text whose segments make a bucket; a task settles one bucket at a time.
BUCKET_BYTES = 1 << 24
#: Different segments of an anchor above which the cluster splits it, and in a task.
SPLIT_ROWS = 20_000
TASK_ROWS = 100
#: One document in so many (and ``SAMPLE_DOCS`` at least) is looked through for hot anchors:
#: those with ``HOT_CONTENTS`` different segments in the sample. An anchor that stays below
#: that has some ten thousands of them in the corpus, whatever its size. At most ``HOT_ANCHORS``
#: of 8 bytes each, the most frequent ones, go to the tasks.
SAMPLE_ONE_IN = 1000
SAMPLE_DOCS = 2000
HOT_CONTENTS = 20
HOT_ANCHORS = 1 << 20
#: Bytes that a task suffix-sorts at a time (whole anchors); each takes about 100 bytes of memory.
SORT_BYTES = 1 << 19
NO_ID = -(1 << 63)
_INDEX = np.uint64((1 << 24) - 1)
_INVERSE = np.uint64(pow(int(MULT), -1, 1 << 64))
_PRIME = np.uint64((1 << 31) - 1)
_BASES = tuple(int(x) for x in np.random.default_rng(20240608).integers(1 << 20, (1 << 31) - 2, 2))
_powers: dict[int, np.ndarray] = {}


# -- anchors ---------------------------------------------------------------------------

def _gram_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k bytes (k a power of two), by doubling."""
    h, factor, have = BYTE_HASH[raw], int(MULT), 1
    while have < k:
        h = h[:-have] * np.uint64(factor) + h[have:]
        factor = factor * factor % (1 << 64)
        have *= 2
    return mix(h)


def _prime_powers(base: int, n: int) -> np.ndarray:
    """The first n (or more) powers of base modulo the prime, kept for the next block."""
    have = _powers.get(base, np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), int(_PRIME))) % _PRIME])
    _powers[base] = have
    return have


def _digests(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """62 bits for each raw[first:end]: its polynomials modulo the prime for the two bases."""
    out = np.zeros(len(first), np.uint64)
    for base in _BASES:
        power, back = _prime_powers(base, len(raw)), _prime_powers(pow(base, -1, int(_PRIME)), len(raw))
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:len(raw)] % _PRIME, out=total[1:])
        out = out << np.uint64(31) | (total[end] - total[first]) % _PRIME * back[first] % _PRIME
    return out


def segments(raw: np.ndarray, offsets: np.ndarray, length: int, k: int):
    """(text, first start, last start, anchor, anchor hash, content hash, content digest) of a
    block's segments, places counted in the block."""
    if len(raw) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 3
    h = _gram_hashes(raw, k)
    keyed = (h & ~_INDEX) | np.arange(len(h), dtype=np.uint64)
    at = (sliding_min(keyed, length - k + 1) & _INDEX).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(at)]
    whole = np.arange(len(at)) + length <= offsets[text + 1]
    change = np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])])
    first = np.flatnonzero(whole & change)
    last = np.flatnonzero(whole & np.concatenate([change[1:] | ~whole[1:], [True]]))
    power = powers(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_HASH[raw] * power[:-1], dtype=np.uint64)])
    back = np.full(len(raw), _INVERSE, np.uint64)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    content = mix((total[last + length] - total[first]) * back[first] + (last - first).astype(np.uint64))
    return text[first], first, last, at[first], h[at[first]], content, _digests(raw, first, last + length)


def _repeats(h, content, digest, did, th, lo):
    """The rows (their numbers) by (anchor, content, occurrence), which of them are the first of
    their content, and the numbers of later occurrences than the first."""
    order = np.lexsort((lo, th, did, digest, content, h))
    fresh = np.ones(len(order), bool)
    fresh[1:] = False
    for x in (h, content, digest):
        x = x[order]
        fresh[1:] |= x[1:] != x[:-1]
    lead = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))] if len(order) else order
    later = np.zeros(len(order), bool)
    for x in (did, th, lo):
        later |= x[order] != x[lead]
    return order, fresh, order[later]


def _join_ranges(did, th, lo, hi):
    """Start ranges, neighbours of a document made one."""
    if not len(did):
        return did, th, lo, hi
    order = np.lexsort((lo, th, did))
    did, th, lo, hi = did[order], th[order], lo[order], hi[order]
    new = np.concatenate([[True], (did[1:] != did[:-1]) | (th[1:] != th[:-1]) | (lo[1:] > hi[:-1] + 1)])
    at = np.flatnonzero(new)
    return did[at], th[at], lo[at], np.maximum.reduceat(hi, at)


_LISTS = ("did", "th", "lo", "span", "anchor", "h", "content", "digest")
_SCAN = ("bucket int, did array<long>, th array<long>, lo array<long>, span array<long>, anchor array<tinyint>, "
         "h array<int>, content array<long>, digest array<long>")


def _stretches(block, length: int, k: int):
    """The segments of a block's texts, stretch by stretch, with the stretch's offsets, its
    place in the text and its size."""
    raw, offsets = utf8(block.column("text"))
    if block.num_rows != 1:
        yield segments(raw, offsets, length, k), offsets, 0, len(raw)
        return
    for at in range(0, max(len(raw) - length + 1, 1), STRETCH):
        part = raw[at:at + STRETCH + length - 1]
        off = np.array([0, len(part)])
        yield segments(part, off, length, k), off, at, len(part)


def hot_anchors(docs: DataFrame, length: int, k: int, text: str = "text", hot_contents: int = HOT_CONTENTS) -> np.ndarray:
    """Sorted hashes of the anchors with many different segments in a sample of ``docs``."""
    part = min(1.0, max(1 / SAMPLE_ONE_IN, SAMPLE_DOCS / max(docs.count(), 1)))
    sample = docs.select("doc_id", text)
    sample = document_key(sample if part == 1 else sample.sample(part, seed=7), text)

    def find(batches):
        for block in text_blocks(batches, "text", SCAN_BYTES):
            for (*_, h, content, _), _, _, _ in _stretches(block, length, k):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(content.view(np.int64))],
                                                 names=["h", "content"])

    n = sample.select("text").mapInArrow(lean(find), "h long, content long").distinct().groupBy("h").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= hot_contents)
    rows = n.orderBy(F.desc("n"), "h").limit(HOT_ANCHORS).select("h").toPandas()["h"].to_numpy()
    return np.sort(rows.astype(np.int64).view(np.uint64))


def _deal(h, content, n_buckets: int, hot: np.ndarray):
    """(bucket, 32 bits of the anchor) of segments. Buckets from ``n_buckets`` on hold the hot
    anchors, dealt by content, with their places in ``hot``."""
    # anchors are minima, so their own high bits crowd near zero: deal by a fresh mix
    bucket = (mix(h + MULT) >> np.uint64(32)).astype(np.int64) * n_buckets >> 32
    low = h.astype(np.uint32)
    if len(hot):
        place = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
        salted = hot[place] == h
        spread = (content >> np.uint64(32)).astype(np.int64) * n_buckets >> 32
        bucket = np.where(salted, n_buckets + spread, bucket)
        low = np.where(salted, place.astype(np.uint32), low)
    return bucket, low.view(np.int32)


def _scan(length: int, k: int, n_buckets: int, hot: np.ndarray = np.zeros(0, np.uint64)):
    def lists(parts):
        """One row: the list columns."""
        offs = lambda x: pa.array([0, len(x)], pa.int32())
        kinds = (np.int64, np.int64, np.int64, np.int64, np.int8, np.int32, np.int64, np.int64)
        return [pa.ListArray.from_arrays(offs(x), pa.array(x.astype(t, copy=False))) for x, t in zip(parts, kinds)]

    def emit(held):
        did, th, lo, hi, anchor, h, content, digest = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order, fresh, later = _repeats(h, content, digest, did, th, lo)
        # repeats inside these texts: settled here, without an anchor
        d, t, a, b = _join_ranges(did[later], th[later], lo[later], hi[later])
        for at in range(0, len(d), 1 << 16):
            s = slice(at, at + (1 << 16))
            none = np.zeros(0, np.int64)
            yield [pa.array([int(d[at] % n_buckets)], pa.int32())] + lists((d[s], t[s], a[s], b[s] - a[s], none, none, none, none))
        first = order[fresh]
        bucket, low = _deal(h[first], content[first], n_buckets, hot)
        order = np.lexsort((lo[first], th[first], did[first], bucket))  # occurrences of a text stand together
        first, bucket, low = first[order], bucket[order], low[order]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(first) else []
        for a, b in zip(cut, np.append(cut[1:], len(first))):
            x = first[a:b]
            yield [pa.array([int(bucket[a])], pa.int32())] + lists(
                (did[x], th[x], lo[x], hi[x] - lo[x], anchor[x] - lo[x],
                 low[a:b], content[x].view(np.int64), digest[x].view(np.int64)))

    def scan(batches):
        held, size = [], 0
        for block in text_blocks(batches, "text", SCAN_BYTES):
            did, th = block.column("did").to_numpy(), block.column("_th").to_numpy()
            for (text, first, last, anchor, h, content, digest), off, at, read in _stretches(block, length, k):
                if len(text):
                    base = off[text] - at
                    held.append((did[text], th[text], first - base, last - base, anchor - base, h, content, digest))
                size += read
            if size >= GATHER_BYTES and held:
                for row in emit(held):
                    yield pa.RecordBatch.from_arrays(row, names=["bucket", *_LISTS])
                held, size = [], 0
        if held:
            for row in emit(held):
                yield pa.RecordBatch.from_arrays(row, names=["bucket", *_LISTS])

    return scan


_ROWS = "did long, th long, lo long, hi long, anchor long, key long"


def _settle(n_buckets: int):
    def settle(batches):
        """The dealt segments, sorted by bucket: rows (did, th, lo, hi) of later occurrences,
        and with anchor and key the first occurrences of an anchor's different contents. One
        bucket is held at a time."""
        held, last = [], None
        for b in batches:
            bucket = b.column("bucket").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
            for at, end in zip(cut, np.append(cut[1:], len(bucket))):
                if held and bucket[at] != last:
                    yield from _settle_bucket(int(last), held, n_buckets)
                    held = []
                last = bucket[at]
                rows = b.slice(int(at), int(end - at))
                size = pc.list_value_length(rows.column("h")).to_numpy()
                for i in np.flatnonzero(size == 0):  # settled ranges pass through
                    d, t, lo, span = (rows.column(c)[int(i)].values.to_numpy() for c in ("did", "th", "lo", "span"))
                    yield _rows(d, t, lo, lo + span)
                keep = rows.filter(pa.array(size > 0))
                if keep.num_rows:
                    held.append(tuple(keep.column(c).flatten().to_numpy() for c in _LISTS))
        if held:
            yield from _settle_bucket(int(last), held, n_buckets)

    return settle


def _settle_bucket(bucket: int, held: list[tuple], n_buckets: int):
    did, th, lo, span, anchor, h, content, digest = (np.concatenate(x) for x in zip(*held))
    held.clear()
    salted = bucket >= n_buckets  # a hot anchor has other contents in other buckets
    key = -1 - h.astype(np.int64) if salted else np.int64(bucket << 32) | h.view(np.uint32).astype(np.int64)
    order, fresh, later = _repeats(key, content, digest, did, th, lo)
    del content, digest
    for x in _parts(later):
        yield _rows(did[x], th[x], lo[x], lo[x] + span[x])
    first = order[fresh]  # of each content, by anchor
    if not salted:
        sorted_key = key[first]
        new = np.ones(len(first), bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        contents = np.diff(np.append(np.flatnonzero(new), len(first)))
        first = first[np.repeat(contents > 1, contents)]
    for x in _parts(first):
        yield _rows(did[x], th[x], lo[x], lo[x] + span[x], lo[x] + anchor[x], key[x])


def _parts(rows: np.ndarray):
    """Row numbers, so many as a batch holds at a time."""
    for at in range(0, len(rows), 1 << 16):
        yield rows[at:at + (1 << 16)]


def _rows(did, th, lo, hi, anchor=None, key=None):
    none = pa.nulls(len(did), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(did), pa.array(th), pa.array(lo), pa.array(hi), none if anchor is None else pa.array(anchor),
         none if key is None else pa.array(key)], names=["did", "th", "lo", "hi", "anchor", "key"])


# -- differing segments ----------------------------------------------------------------

_SEGMENT = "key long, did long, th long, lo long, hi long, c0 long, c1 long, bytes binary"


def _halves(length: int, row: tuple) -> list[tuple]:
    """A segment (key, did, th, lo, hi, c0, c1, bytes) whose strings all hold the bytes
    c0..c1-1, as the strings that reach ``half`` bytes further right and the others, which
    reach further left."""
    key, did, th, lo, hi, c0, c1, data = row
    room = length - (c1 - c0)
    half = (room + 1) // 2
    out = []
    first = c1 + half - length  # starts from here on reach c1 + half
    if max(lo, first) <= hi:
        a = max(lo, first)
        part = data[c1 - lo:c1 + half - lo]
        out.append((_key(key, b"R", part), did, th, a, hi, c0, c1 + half, data[a - lo:]))
    if lo < first and min(hi, first - 1) >= lo:
        b = min(hi, first - 1)
        left = room - half + 1
        part = data[c0 - left - lo:c0 - lo]
        out.append((_key(key, b"L", part), did, th, lo, b, c0 - left, c1, data[:b + length - lo]))
    return out


def _key(key: int, side: bytes, part: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(key.to_bytes(8, "little", signed=True) + side + part, digest_size=8).digest(),
                          "little", signed=True)


def _split_buckets(rows: list[tuple], length: int, task_rows: int, removed: list, ready: list) -> None:
    """Puts the bucket's rows into ``ready`` as buckets of at most ``task_rows``, or settles them."""
    work = [rows]
    while work:
        rows = work.pop()
        by: dict[bytes, list[tuple]] = {}
        for r in rows:
            by.setdefault(r[7], []).append(r)
        rows = []
        for same in by.values():
            least = min(same, key=lambda r: r[1:4])
            rows.append(least)
            removed += [r[1:5] for r in same if r[1:4] != least[1:4]]
        if len(rows) < 2:
            continue
        if len(rows) <= task_rows or rows[0][6] - rows[0][5] >= length:
            ready.append(rows)
            continue
        parts: dict[int, list[tuple]] = {}
        for r in rows:
            for x in _halves(length, r):
                parts.setdefault(x[0], []).append(x)
        work += parts.values()


def sorted_repeats(buckets: list[list[tuple]], length: int):
    """(did, th, start) arrays of the strings that are not the first of their kind, from the
    suffix order of each bucket's segments."""
    sym, start, at, did, th, lo = [], [], [], [], [], []
    n = 0
    for rows in buckets:
        start.append(n)
        for r in rows:
            data = np.frombuffer(r[7], np.uint8)
            sym += [data.astype(np.int16) + 2, [1]]
            at.append((n, r[4] - r[3] + 1))
            did.append(r[1]), th.append(r[2]), lo.append(r[3])
            n += len(data) + 1
        sym.append([0])
        n += 1
    flat = np.concatenate(sym).astype(np.int16)
    order = suffix_order(flat, np.array(start))
    owner = np.full(n, -1, np.int64)  # the segment whose string starts here
    for i, (a, m) in enumerate(at):
        owner[a:a + m] = i
    order = order[owner[order] >= 0]
    if len(order) < 2:
        return (np.zeros(0, np.int64),) * 3
    view = np.lib.stride_tricks.sliding_window_view((flat - 2).astype(np.uint8), length)
    same = np.zeros(len(order), bool)
    bucket = np.searchsorted(np.array(start), order, side="right")
    for a in range(1, len(order), 1 << 15):
        x = order[a - 1:a + (1 << 15)]
        rows = view[x]
        same[a:a + (1 << 15)] = (rows[1:] == rows[:-1]).all(axis=1)
    same[1:] &= bucket[1:] == bucket[:-1]
    kind = np.cumsum(~same)
    did, th, lo = np.array(did), np.array(th), np.array(lo)
    begin = np.array([a for a, _ in at])
    own = owner[order]
    d, t, s = did[own], th[own], lo[own] + order - begin[own]
    by = np.lexsort((s, t, d, kind))
    first = np.concatenate([[True], kind[by][1:] != kind[by][:-1]])
    gone = by[~first]
    return d[gone], t[gone], s[gone]


def _sort(length: int, task_rows: int):
    def solve(buckets):
        """``buckets`` of whole anchors, in sweeps of similar sizes."""
        removed: list[tuple] = []
        ready: list[list[tuple]] = []
        for rows in buckets:
            _split_buckets(rows, length, task_rows, removed, ready)
        if removed:
            yield _rows(*_join_ranges(*(np.array(x, np.int64) for x in zip(*removed))))
        ready.sort(key=lambda rows: sum(len(r[7]) for r in rows))
        part, size = [], 0
        for i, rows in enumerate(ready):
            part.append(rows)
            size += sum(len(r[7]) for r in rows)
            if size >= SORT_BYTES or i == len(ready) - 1:
                d, t, s = sorted_repeats(part, length)
                yield _rows(*_join_ranges(d, t, s, s))
                part, size = [], 0

    def run(batches):
        buckets: list[list[tuple]] = []
        size, last = 0, None
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                if row[0] != last:
                    if size >= 4 * SORT_BYTES:
                        yield from solve(buckets)
                        buckets, size = [], 0
                    buckets.append([])
                    last = row[0]
                buckets[-1].append(row)
                size += len(row[7])
        yield from solve(buckets)

    return run


def repeated_starts(docs: DataFrame, length: int = 100, k: int = GRAM, text: str = "text",
                    split_rows: int = SPLIT_ROWS, task_rows: int = TASK_ROWS, hot_contents: int = HOT_CONTENTS) -> DataFrame:
    """did, th, lo, hi: ranges of places in a document (did: doc_id, or NO_ID for null)
    where strings of ``length`` bytes start that also start earlier."""
    spark = docs.sparkSession
    own = document_key(docs, text).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), "_th", "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(n, -(-size // BUCKET_BYTES))
    dealt = own.mapInArrow(lean(_scan(length, k, n_buckets, hot_anchors(docs, length, k, text, hot_contents))), _SCAN)
    dealt = dealt.repartition(n, "bucket").sortWithinPartitions("bucket")
    settled = materialise(dealt.mapInArrow(lean(_settle(n_buckets)), _ROWS), "segments")
    found = [settled.where("key is null").select("did", "th", "lo", "hi")]

    # the bytes of the differing segments
    want = settled.where("key is not null").groupBy("did", "th").agg(
        F.collect_list(F.struct("key", "lo", "hi", "anchor")).alias("want"))
    joined = own.join(want, (own["did"] == want["did"]) & (own["_th"] == want["th"])).select(
        want["did"], want["th"], "text", "want")

    def fetch(batches):
        for block in text_blocks(batches):
            out: list[list] = [[] for _ in range(8)]
            for did, th, t, rows in zip(*(block.column(c).to_pylist() for c in ("did", "th", "text", "want"))):
                data = t.encode()
                for r in rows:
                    for column, v in zip(out, (r["key"], did, th, r["lo"], r["hi"], r["anchor"], r["anchor"] + k,
                                               data[r["lo"]:r["hi"] + length])):
                        column.append(v)
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)],
                                             names=["key", "did", "th", "lo", "hi", "c0", "c1", "bytes"])

    rows = materialise(joined.mapInArrow(lean(fetch), _SEGMENT), "segment-bytes")
    while True:  # at most log2(length) times: each split halves what strings of an anchor do not share
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("c1") - F.col("c0")).alias("shared"))
        hot = sizes.where((F.col("n") > split_rows) & (F.col("shared") < length)).select("key")
        if not hot.limit(1).count():
            found.append(_sort_segments(rows, length, task_rows))
            break
        found.append(_sort_segments(rows.join(hot, "key", "left_anti"), length, task_rows))

        def split(batches):
            for b in batches:
                out = [x for row in zip(*(b.column(c).to_pylist() for c in b.schema.names)) for x in _halves(length, row)]
                kinds = [pa.int64()] * 7 + [pa.binary()]
                columns = list(zip(*out)) or [[]] * 8
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], names=b.schema.names)

        parts = materialise(rows.join(hot, "key", "left_semi").select(rows.columns).mapInArrow(lean(split), _SEGMENT), "segment-halves")
        place = F.struct("did", "th", "lo")
        least = parts.groupBy("key", F.md5("bytes").alias("_md5")).agg(F.min(place).alias("_first"))
        both = parts.withColumn("_md5", F.md5("bytes")).join(least, ["key", "_md5"]).withColumn("_own", place)
        found.append(both.where("_own <> _first").select("did", "th", "lo", "hi"))
        rows = materialise(both.where("_own = _first").select(rows.columns), "segment-rest")
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out


def _sort_segments(rows: DataFrame, length: int, task_rows: int) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(
        lean(_sort(length, task_rows)), _ROWS).select("did", "th", "lo", "hi")


# -- results ---------------------------------------------------------------------------

def merge_spans(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the strings starting in the ranges cover."""
    out: list[list[int]] = []
    for a, b in sorted(starts):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b + length)
        else:
            out.append([a, b + length])
    return [(a, b) for a, b in out]


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def repeated_spans(docs: DataFrame, length: int = 100, text: str = "text", **how) -> DataFrame:
    """did, th, starts: per document with repeats, the start ranges."""
    return repeated_starts(docs, length, text=text, **how).groupBy("did", "th").agg(
        F.collect_list(F.struct("lo", "hi")).alias("starts"))


def repeat_report(docs: DataFrame, length: int = 100, text: str = "text", **how) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    own = document_key(docs, text).withColumn("did", F.coalesce("doc_id", F.lit(NO_ID))).alias("d")
    spans = repeated_spans(docs, length, text, **how).alias("s")
    joined = own.join(spans, F.expr("d.did = s.did and d._th = s.th"), "left").select("doc_id", "text", "starts")

    def report(batches):
        for block in text_blocks(batches, "text", 1 << 22):
            out: list[list] = [[], [], [], []]
            for t, starts in zip(block.column("text").to_pylist(), block.column("starts").to_pylist()):
                data = t.encode()
                s = merge_spans([(x["lo"], x["hi"]) for x in starts or ()], length)
                kept = _kept(data, s)
                for column, v in zip(out, (len(data), len(data) - len(kept), len(s), hashlib.sha256(kept).hexdigest())):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id")] + [pa.array(v, t) for v, t in zip(out, (pa.int64(),) * 3 + (pa.string(),))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(lean(report), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 100, text: str = "text", **how) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text. Bytes of a character that
    was cut in two go with it; a null text stays null."""
    id_, th, cuts = fresh(docs, "_own_id", "_own_th", "_starts")
    own = docs.withColumns({id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                            th: F.xxhash64(F.coalesce(F.col(text), F.lit("")))}).alias("d")
    spans = repeated_spans(docs, length, text, **how).alias("s")
    joined = own.join(spans, (F.col(f"d.{id_}") == F.col("s.did")) & (F.col(f"d.{th}") == F.col("s.th")), "left").select(
        *[F.col(f"d.`{c}`") for c in docs.columns], F.col("s.starts").alias(cuts))
    names, schema = docs.columns, docs.schema
    at = names.index(text)

    def cut(batches):
        for block in text_blocks(batches, text, 1 << 22):
            texts = [t if t is None or not starts else
                     _kept(t.encode(), merge_spans([(x["lo"], x["hi"]) for x in starts], length)).decode("utf-8", "ignore")
                     for t, starts in zip(block.column(text).to_pylist(), block.column(cuts).to_pylist())]
            columns = [block.column(c) for c in names]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(lean(cut), schema)
