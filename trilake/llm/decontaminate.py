"""Benchmark decontamination by winnowing.

A fingerprint of a text is the smallest of every ``window - k + 1`` consecutive k-gram
hashes, so any shared run of ``window`` words shares a fingerprint at the same place.

1. Fingerprints and windows of the benchmark: one row for each distinct one (equal texts
   and passages common to many items meet in one row).
2. One scan of the documents emits the fingerprints that may be in the benchmark, with
   the few words around each. "May" is a bit filter over the benchmark's fingerprints:
   its size is set from their number and never above ``FILTER_BITS`` (16 MB); beyond that
   it lets more through, and the join that follows stays exact.
3. Join on the fingerprint, then extend each hit: the windows that hold it are compared
   word for word with the benchmark's windows.
4. Hit words of a document are the union of its matched windows.
5. Items: windows that occur in the same items are one class, documents that hold the same
   classes one group. A group's items are put together once, so a passage common to many
   items and many documents does not multiply.

An item of fewer words than a window is one window; those (at most ``window - 1``)
lengths are fingerprinted at every place.

Cases: null and empty texts have no words (never contaminated; items without windows);
null or repeated doc_ids and repeated rows: rows with the same doc_id and text are one
document, each gets its result; null item_ids count for hits and are not listed; empty
tables give no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import (Words, document_key, fresh, grams, materialise, sliding_min,
                     text_blocks, utf8, word_cuts)

#: Largest bit filter sent to the tasks: 2**27 bits are 16 MB.
FILTER_BITS = 1 << 27
GRAM = 8
#: Bytes of one text that are scanned at a time.
PIECE = 1 << 22
_INDEX = np.uint64((1 << 24) - 1)
_HITS = ("array<struct<n:int,h:long,at:long,words:string>>")


def fingerprints(words: Words, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the winnowed k-grams of a block's texts, as places of words."""
    n = len(words.hash)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = grams(words.hash, k)[:n - k + 1]
    keyed = (h & ~_INDEX) | np.arange(len(h), dtype=np.uint64)  # ties go to the first place
    least = sliding_min(keyed, window - k + 1)
    whole = words.doc[:len(least)] == words.doc[window - 1:window - 1 + len(least)]
    at = np.unique((least[whole] & _INDEX).astype(np.int64))
    return at, h[at]


def short_grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of every run of n words."""
    if len(words.hash) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = grams(words.hash, n)[:len(words.hash) - n + 1]
    at = np.flatnonzero(words.doc[:len(h)] == words.doc[n - 1:])
    return at, h[at]


def benchmark_tables(benchmark: DataFrame, window: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(fingerprints: n, h; windows: n, words, item_id) of the items."""

    def emit(batches):
        for block in text_blocks(batches, "text"):
            words = Words(*utf8(block.column("text")))
            items = block.column("item_id").to_pylist()
            out: list[list] = [[], [], [], []]
            for i, item in enumerate(items):
                a, b = int(words.first[i]), int(words.first[i + 1])
                n = min(window, b - a)
                for at in range(a, b - n + 1 if n else a):
                    for column, v in zip(out, (n, None, words.text(at, at + n), item)):
                        column.append(v)
            sets = [(window, *fingerprints(words, window, k))]
            for n in sorted({int(c) for c in words.count if 0 < c < window}):
                at, h = short_grams(words, n)
                own = words.count[words.doc[at]] == n
                sets.append((n, at[own], h[own]))
            for n, at, h in sets:
                out[0] += [n] * len(h)
                out[1] += h.view(np.int64).tolist()
                out[2] += [None] * len(h)
                out[3] += [None] * len(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, (pa.int32(), pa.int64(), pa.string(), pa.int64()))],
                names=["n", "h", "words", "item_id"])

    rows = materialise(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        emit, "n int, h long, words string, item_id long"), "benchmark-windows")
    return (rows.where("h is not null").select("n", "h").distinct(),
            rows.where("words is not null").select("n", "words", "item_id").distinct())


class BitFilter:
    """Two bits for each 64-bit hash; false hits only cost a row in the exact join."""

    def __init__(self, prints: DataFrame):
        n = prints.count()
        self.bits = min(FILTER_BITS, 1 << max(16, (16 * n).bit_length()))
        # the bits as 64-bit words: at most FILTER_BITS / 64 rows reach the driver
        bit = F.explode(F.array(*[F.shiftrightunsigned("h", s).bitwiseAND(self.bits - 1) for s in (0, 31)]))
        words = prints.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("v"))
        self.words = np.zeros(self.bits // 64, np.uint64)
        pdf = words.toPandas()
        if len(pdf):
            self.words[pdf["w"].to_numpy().astype(np.int64)] = pdf["v"].to_numpy().astype(np.int64).view(np.uint64)

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for s in (0, 31):
            b = (h >> np.uint64(s)) & np.uint64(self.bits - 1)
            out &= (self.words[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63)) & np.uint64(1)) == 1
        return out


def document_hits(docs: DataFrame, prints: DataFrame, window: int, k: int, text: str = "text") -> DataFrame:
    """doc_id, _th, n_words and the possible hits of every document: (n, hash, first word,
    the words around it that a window with this fingerprint can have)."""
    lengths = [r["n"] for r in prints.select("n").distinct().collect()]  # at most `window` values
    short = sorted(n for n in lengths if n < window)
    bits = BitFilter(prints)
    reach = window - k

    def stretches(raw, offsets):
        """(words, words before, own words) of a block; a very long text in overlapping
        stretches, each with the ``window - 1`` words that follow it."""
        if len(offsets) > 2 or len(raw) <= PIECE:
            words = Words(raw, offsets)
            yield words, 0, words.count
            return
        cuts, before = word_cuts(raw, PIECE), 0
        for a, b in zip(cuts, cuts[1:]):
            own = len(Words(raw[a:b], np.array([0, b - a])).hash)
            more = 4096
            while True:
                end = word_cuts(raw[b:], more)[1] + b if b + more < len(raw) else len(raw)
                words = Words(raw[a:end], np.array([0, end - a]))
                if end == len(raw) or len(words.hash) >= own + window - 1:
                    break
                more *= 4
            yield words, before, np.array([own])
            before += own

    def scan(batches):
        for block in text_blocks(batches, "text"):
            hits: list[list] = [[] for _ in range(block.num_rows)]
            total = np.zeros(block.num_rows, np.int64)
            for words, before, own in stretches(*utf8(block.column("text"))):
                total += own
                find(words, before, hits)
            kind = pa.list_(pa.struct([("n", pa.int32()), ("h", pa.int64()), ("at", pa.int64()), ("words", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), block.column("_th"), pa.array(total), pa.array(hits, kind)],
                names=["doc_id", "_th", "n_words", "hits"])

    def find(words, before, hits):
        for n, (at, h) in [(window, fingerprints(words, window, k))] + [(n, short_grams(words, n)) for n in short]:
            may = bits.may_hold(h)
            for i, x in zip(at[may].tolist(), h[may].view(np.int64).tolist()):
                d = int(words.doc[i])
                a, b = (i, i + n) if n < window else (max(int(words.first[d]), i - reach),
                                                     min(int(words.first[d + 1]), i + k + reach))
                hits[d].append({"n": n, "h": x, "at": before + a - int(words.first[d]), "words": words.text(a, b)})

    return materialise(document_key(docs, text).mapInArrow(
        scan, f"doc_id long, _th long, n_words long, hits {_HITS}"), "document-hits")


def window_classes(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(n, words, class; class, item_id): windows that occur in the same items, by 128 bits of
    the set of item ids and its size, and the items of each class."""
    known = windows.where("item_id is not null")  # distinct rows
    bits = [F.bit_xor(F.xxhash64(F.lit(seed), "item_id")) for seed in (1, 2)]
    of = materialise(known.groupBy("n", "words").agg(F.md5(F.concat_ws(":", F.count(F.lit(1)), *bits)).alias("class")),
                     "window-classes")
    one = of.groupBy("class").agg(F.min(F.struct("n", "words")).alias("w")).select("class", "w.n", "w.words")
    return of, known.join(one, ["n", "words"]).select("class", "item_id")


def document_items(found: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, _th, items (sorted as strings) of documents with windows of named items."""
    of, members = window_classes(windows)
    held = found.select("doc_id", "_th", "n", "words").join(of, ["n", "words"]).select("doc_id", "_th", "class").distinct()
    held = held.groupBy("doc_id", "_th").agg(F.array_sort(F.collect_list("class")).alias("classes"))
    groups = materialise(held.withColumn("group", F.md5(F.array_join("classes", ","))), "document-groups")
    each = groups.groupBy("group").agg(F.first("classes").alias("classes"))
    # written before the join: both its sides then have exchanges of their own, so the
    # documents of a frequent group are split
    items = materialise(each.select("group", F.explode("classes").alias("class")).join(members, "class").groupBy("group").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")), "group-items")
    return groups.select("doc_id", "_th", "group").join(items, "group").select("doc_id", "_th", "items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, k: int = GRAM,
                  one_in: int = 20, text: str = "text") -> DataFrame:
    """Per document: doc_id, _th, n_words, n_hit, n_items, items (sorted as strings),
    contaminated (hit words are at least one in ``one_in``)."""
    prints, windows = benchmark_tables(benchmark, window, k)
    rows = document_hits(docs, prints, window, k, text)
    hits = rows.where(F.size("hits") > 0).select("doc_id", "_th", F.explode("hits").alias("hit")).select(
        "doc_id", "_th", "hit.*").distinct()
    real = hits.join(prints, ["n", "h"], "left_semi")
    # extend: every window of n words around the fingerprint, compared word for word
    parts = real.withColumn("w", F.split("words", " ")).select(
        "doc_id", "_th", "n", "at", "w", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("n"))).alias("j")).select(
        "doc_id", "_th", "n", (F.col("at") + F.col("j")).alias("at"),
        F.array_join(F.slice("w", F.col("j") + 1, F.col("n")), " ").alias("words")).distinct()
    found = materialise(parts.join(windows.select("n", "words").distinct(), ["n", "words"], "left_semi"), "windows-found")
    key = Window.partitionBy("doc_id", "_th").orderBy("at", "n")
    end = F.col("at") + F.col("n")
    hit = found.select("doc_id", "_th", "at", "n").distinct().withColumn(
        "reached", F.coalesce(F.max(end).over(key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).groupBy(
        "doc_id", "_th").agg(F.sum(F.greatest(end - F.greatest("at", "reached"), F.lit(0))).alias("n_hit"))
    items = document_items(found, windows)
    hit, items = hit.alias("hit"), items.alias("items")
    out = rows.select("doc_id", "_th", "n_words").alias("d")
    out = out.join(hit, F.expr("d.doc_id <=> hit.doc_id and d._th = hit._th"), "left").join(
        items, F.expr("d.doc_id <=> items.doc_id and d._th = items._th"), "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    found_items = F.coalesce(F.col("items.items"), F.array().cast("array<string>"))
    return out.select("d.doc_id", "d._th", "d.n_words", n_hit.alias("n_hit"),
                      F.size(found_items).cast("long").alias("n_items"), found_items.alias("items"),
                      ((n_hit > 0) & (n_hit * one_in >= F.col("d.n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = contamination(docs, benchmark, **how).where("contaminated").select("doc_id", "_th").distinct()
    [th] = fresh(docs, "_own_th")
    own = docs.withColumn(th, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    return own.join(bad, own["doc_id"].eqNullSafe(bad["doc_id"]) & (own[th] == bad["_th"]), "left_anti").drop(th)
