"""SimHash near-duplicates with a Gray-order hierarchical index.

1. Fingerprint: a bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of a
   text's word shingles, repeats included. One scan; equal fingerprints become one row.
2. Buckets: 64 bits are cut into ``max_bits + 1`` blocks; fingerprints within ``max_bits``
   agree on one block at least, so each is dealt out once for each block, by that block's
   value. A bucket of more than ``bucket_rows`` fingerprints is dealt anew by blocks of its
   remaining bits, and so on: an exact split, as two members still agree on one of them.
3. Index (in a task, over its buckets): a bucket's fingerprints are sorted by Gray rank, so
   neighbours share most bits. Eight neighbours form a node that holds the bits they share
   (a mask and a pattern), eight nodes form a node above, up to the bucket's root.
4. Search: pairs of nodes from the root down. A pair's differences accumulate: each level
   adds the differing bits among those that both masks newly fix. A pair over ``max_bits``
   is dropped with all the fingerprints below it; at the leaves the sum is the distance.
   So is a pair whose fingerprints are all in one component already, which keeps a bucket
   of very many near fingerprints from costing the square of its size.
5. A bucket's links become a spanning forest; the forests' components are joined on the
   cluster (``star_components``).

Cases: null, empty and blank texts have fingerprint zero and link like any other; null
doc_ids take part but never name a component unless a component has no other id; repeated
rows and ids are ordinary; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import document_key, fresh, materialise, text_blocks, whole_groups
from .components import star_components

FANOUT = 8
#: Fingerprints in a bucket above which it is split by its remaining bits.
BUCKET_ROWS = 20_000
#: Fingerprints whose index is built at a time (whole buckets).
INDEX_ROWS = 200_000
#: Bytes of one text that are hashed at a time.
PIECE = 1 << 22
_ALL = (1 << 64) - 1
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


# -- fingerprints ----------------------------------------------------------------------

def _ones(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit, highest first."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = np.array(hashes[at:at + 8192], ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return ones


def fingerprint(text: str, n: int) -> int:
    """The bits set in over half of the XXH64 of every n words (of the whole sequence, if
    fewer). A very long text is read in pieces that share n - 1 words."""
    import xxhash
    h = xxhash.xxh64_intdigest
    data = text.encode().lower()  # bytes: A-Z only, and ASCII white space only
    ones, total, at, held = np.zeros(64, np.int64), 0, 0, []
    while at < len(data):
        gap = _SPACE.search(data, at + PIECE)
        to = gap.start() if gap else len(data)
        words = held + data[at:to].split()
        at = to
        if len(words) >= n:
            line = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
            ends = np.cumsum(sizes)
            hashes = [h(line[a:b], 42) for a, b in zip((ends - sizes).tolist(), (ends[n - 1:] - 1).tolist())]
            ones, total = ones + _ones(hashes), total + len(hashes)
        held = words[max(0, len(words) - n + 1):]
    if not total and held:
        ones, total = _ones([h(b" ".join(held), 42)]), 1
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big") if total else 0


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """doc_id, _th and fp (the 64 bits as a long) of every document."""

    def scan(batches):
        for block in text_blocks(batches, "text", 1 << 22):
            fps = [fingerprint(t or "", shingle) for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("_th"), pa.array(np.array(fps, np.uint64).view(np.int64))],
                names=["doc_id", "_th", "fp"])

    return document_key(docs, text).mapInArrow(scan, "doc_id long, _th long, fp long")


# -- buckets ---------------------------------------------------------------------------

def block_masks(fixed: int, blocks: int) -> list[int]:
    """``fixed`` (a mask) with each of the blocks that its open bits are cut into."""
    bits = [i for i in range(63, -1, -1) if not fixed >> i & 1]
    cuts = [len(bits) * i // blocks for i in range(blocks + 1)]
    return [fixed | sum(1 << i for i in bits[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Each row (fp, mask) once for each of the masks that follow its mask. The table of
    masks has ``blocks`` to the power of the level rows, whatever the data."""
    if len(masks) == 1:
        [following] = masks.values()
        dealt = rows.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in following])).alias("mask"))
    else:
        pairs = [(_signed(m), _signed(x)) for m, following in masks.items() for x in following]
        after = rows.sparkSession.createDataFrame(pairs, "mask long, after long")
        dealt = rows.join(F.broadcast(after), "mask").select("fp", F.col("after").alias("mask"))
    return dealt.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))


def buckets(fps: DataFrame, blocks: int, bucket_rows: int = BUCKET_ROWS) -> list[DataFrame]:
    """(fp, mask, value) tables of buckets of two fingerprints at least and, but for the
    last level that bits allow, at most ``bucket_rows``."""
    out, masks = [], {0: block_masks(0, blocks)}
    rows = fps.select("fp", F.lit(0).cast("long").alias("mask"))
    while True:
        dealt = materialise(_deal(rows, masks), "buckets")
        n = dealt.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        n = materialise(n, "bucket-sizes")
        open_bits = 64 - min(m.bit_count() for f in masks.values() for m in f)
        if open_bits <= blocks or not n.where(F.col("n") > bucket_rows).limit(1).count():
            return [*out, dealt.join(n.select("mask", "value"), ["mask", "value"])]
        out.append(dealt.join(n.where(F.col("n") <= bucket_rows).select("mask", "value"), ["mask", "value"]))
        rows = dealt.join(n.where(F.col("n") > bucket_rows).select("mask", "value"), ["mask", "value"]).select("fp", "mask")
        masks = {m: block_masks(m, blocks) for f in masks.values() for m in f}


# -- index -----------------------------------------------------------------------------

def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of a code word in Gray order."""
    rank = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


class Index:
    """Gray-sorted fingerprints of whole buckets with levels of nodes above them.

    Level 0 are the fingerprints. A node's children are ``first[i]..first[i+1]-1`` of the
    level below; ``mask`` has the bits that all its fingerprints share, ``bits`` their
    values. The last level has one node for each bucket."""

    def __init__(self, fp: np.ndarray, bucket: np.ndarray):
        order = np.lexsort((gray_rank(fp), bucket))
        self.order = order
        fp, bucket = fp[order], bucket[order]
        self.levels = [(np.full(len(fp), _ALL, np.uint64), fp, None)]
        low, high = fp, fp
        while True:
            start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            size = np.diff(np.append(start, len(bucket)))
            if (size == 1).all() and len(self.levels) > 1:
                break
            place = np.arange(len(bucket)) - np.repeat(start, size)
            first = np.flatnonzero(place % FANOUT == 0)
            low, high = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)
            mask = ~(low ^ high)
            self.levels.append((mask, low & mask, np.append(first, len(bucket))))
            bucket = bucket[first]

    def groups(self, label: np.ndarray) -> list[np.ndarray]:
        """For each level, the label that all fingerprints of a node have, or -1."""
        out = [label]
        for _, _, first in self.levels[1:]:
            low = np.minimum.reduceat(out[-1], first[:-1])
            high = np.maximum.reduceat(out[-1], first[:-1])
            out.append(np.where(low == high, low, -1))
        return out

    def links(self, most: int, chunk: int = 1 << 15, label: np.ndarray | None = None):
        """Arrays (i, j) of pairs of fingerprints of a bucket within ``most`` bits, by place.
        With ``label`` (the caller changes it in place, see ``_merge``) pairs that have the
        same label already are left out."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        zero = np.zeros(len(roots), np.uint64)
        stack = [(top, roots, roots, zero.astype(np.int64), zero)]
        step = np.arange(FANOUT)
        same, seen = None, None
        while stack:
            level, a, b, differ, shared = stack.pop()
            if len(a) > chunk:
                stack += [(level, a[at:at + chunk], b[at:at + chunk], differ[at:at + chunk], shared[at:at + chunk])
                          for at in range(0, len(a), chunk)]
                continue
            if label is not None:
                if seen is None or (seen != label).any():
                    same, seen = self.groups(label), label.copy()
                open_ = (same[level][a] < 0) | (same[level][a] != same[level][b])
                a, b, differ, shared = a[open_], b[open_], differ[open_], shared[open_]
            first = self.levels[level][2]
            i = (first[a][:, None] + step)[:, :, None]
            j = (first[b][:, None] + step)[:, None, :]
            ok = (i < first[a + 1][:, None, None]) & (j < first[b + 1][:, None, None]) & \
                ((a != b)[:, None, None] | (i <= j))
            if level == 1:
                ok &= i != j
            pair, x, y = np.nonzero(ok)
            i, j = first[a[pair]] + x, first[b[pair]] + y
            mask, bits, _ = self.levels[level - 1]
            both = mask[i] & mask[j]
            total = differ[pair] + np.bitwise_count((bits[i] ^ bits[j]) & both & ~shared[pair])
            near = total <= most
            if level == 1:
                yield i[near], j[near]
            elif near.any():
                stack.append((level - 1, i[near], j[near], total[near], both[near]))


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label`` (each place's smallest linked place so far) with more links, in place."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _forest(fp: np.ndarray, bucket: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, its root) that span the same groups as all links do."""
    index = Index(fp, bucket)
    label = np.arange(len(fp))
    for i, j in index.links(most, label=label):
        if len(i):
            _merge(label, i, j)
    own = index.levels[0][1]
    at = np.flatnonzero(label != np.arange(len(fp)))
    return own[at], own[label[at]]


def bucket_links(rows: DataFrame, most: int) -> DataFrame:
    """a, b: spanning links of the buckets (fp, mask, value)."""

    def search(batches):
        for table in whole_groups(batches, ["mask", "value"], INDEX_ROWS):
            mask, value, fp = (table.column(c).to_numpy() for c in ("mask", "value", "fp"))
            new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
            a, b = _forest(fp.view(np.uint64), np.cumsum(new), most)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    dealt = rows.select("mask", "value", "fp").repartition("mask", "value").sortWithinPartitions("mask", "value")
    return dealt.mapInArrow(search, "a long, b long")


# -- groups ----------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text: str = "text",
                    bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links) of every document,
    _th, the hash of its text, and _root, the component's smallest fingerprint: unlike
    component_id it is never null and no two components share it."""
    rows = materialise(fingerprints(docs, shingle, text), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = None
    for table in buckets(nodes.select("fp"), max_bits + 1, bucket_rows):
        part = bucket_links(table, max_bits)
        links = part if links is None else links.union(part)
    stars = star_components(links)
    joined = nodes.join(stars, nodes["fp"] == stars["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    names = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = joined.select("fp", "root").join(names, "root").select(F.col("fp").alias("_fp"), "component_id", F.col("root").alias("_root"))
    return rows.join(classes, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id", "_th", "_root")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the smallest doc_id (null ids last), and of
    rows that share it the one with the smallest text hash (identical rows stay one row)."""
    [th] = fresh(docs, "_own_th")
    own = docs.withColumn(th, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    found = near_duplicates(docs, shingle, max_bits, text).groupBy("_root", "doc_id", "_th").agg(F.count(F.lit(1)).alias("_n"))
    least = found.groupBy("_root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_th", "_n")).alias("w"))
    chosen = materialise(least.select(F.col("w.doc_id").alias("id"), F.col("w._th").alias("least"), F.col("w._n").alias("n")), "kept-ids")

    def keep(ids):
        return own.join(ids, own["doc_id"].eqNullSafe(ids["id"]) & (own[th] == ids["least"]), "left_semi")

    kept = keep(chosen.where("n = 1"))
    if chosen.where("n > 1").limit(1).count():  # rows that the table repeats
        kept = kept.union(keep(chosen.where("n > 1")).dropDuplicates(["doc_id", th]))
    return kept.drop(th)
