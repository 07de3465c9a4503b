"""Ranked lexical search over norm buckets (LEMP style).

A document's score for an item is the inner product of the item's vector (a weight for each
of its terms) and the document's impact vector. Both are scaled by the square root of the
weight, which leaves the product and shortens common terms.

1. The items' distinct term sets are the queries. Their terms are the vocabulary; with more
   than ``MAX_TERMS`` terms in all, the queries are taken in blocks, a pass for each.
2. One scan counts every document's words and its vocabulary terms (whole texts; a hit is
   compared byte by byte, not only by hash). Document frequencies, N and L are aggregates.
3. The impact vectors are sorted by length over the whole corpus and cut into buckets of
   ``BUCKET`` rows. Equal lengths are cut anywhere, so copies spread over buckets.
4. The search takes the buckets from the longest on, in rounds over a growing share of the
   corpus; a round starts with the k-th best scores of the rounds before.
   - Cauchy-Schwarz: a bucket whose longest vector times the query's length is below the
     query's k-th best score is skipped; so are, in the scan itself, lengths that no query
     can use any more.
   - Coordinates: inside a bucket the products of the query's ``FOCUS`` heaviest terms are
     summed, and the rest is bounded by the two remaining lengths. Documents below the k-th
     best score go.
   - Survivors are scored exactly in 64-bit integers.
   All bounds are widened by a relative ``_SLACK``, and only strictly smaller ones prune, so
   ties stay for the order by doc_id.

The driver holds the vocabulary's weights and one score per query of the block (both bounded
by ``MAX_TERMS``) and a row per partition of the sorted table.

Cases: null and empty texts have no terms (an item without terms has no rows, a document
without terms is not counted in N); repeated rows and doc_ids are documents of their own and
take ranks of their own; null doc_ids come last among equal scores; each row of ``items`` is
an item, null or repeated ids included (equal texts are searched once); with fewer than k
documents above 0 all are returned; empty tables give no rows; other columns are ignored.
Texts above ``PIECE`` bytes are counted in pieces cut between words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import Words, materialise, range_sorted, text_blocks, utf8, word_cuts

#: Most terms (summed over the queries) of one pass: about 10 MB in every task.
MAX_TERMS = 1 << 18
BUCKET = 4096
FOCUS = 8
#: Shares of the documents that the first rounds cover; the last round covers the rest.
ROUNDS = (0.02, 0.15)
PIECE = 1 << 22
_SLACK = 1e-9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_TOP = "q int, score long, doc_id long"


def item_queries(items: DataFrame) -> DataFrame:
    """``item_id``, ``terms`` (sorted distinct words of the text) and ``key`` (their hash)."""
    clean = F.translate(F.coalesce("text", F.lit("")), _UPPER + _BETWEEN, _LOWER + " " * len(_BETWEEN))
    terms = F.array_sort(F.array_distinct(F.array_remove(F.split(clean, " "), "")))
    return items.select(F.col("item_id").alias("item_id"), terms.alias("terms")).withColumn(
        "key", F.sha2(F.array_join("terms", " "), 256)).where(F.size("terms") > 0)


class Vocabulary:
    """The terms of a block of queries, found in texts by hash and then byte by byte."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        raw, offsets = utf8(pa.array(terms, pa.string()))
        words = Words(raw, offsets)
        order = np.argsort(words.hash, kind="stable")
        self.hash, self.term = words.hash[order], order.astype(np.int32)
        self.raw, self.offsets = words.low, offsets
        same = np.diff(np.flatnonzero(np.concatenate([[True], self.hash[1:] != self.hash[:-1], [True]])))
        self.depth = int(same.max(initial=1))  # terms with one hash; 1 but for a collision

    def __len__(self):
        return len(self.terms)

    def places(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(indices of the words that are terms, their terms)."""
        if not len(self.hash) or not len(words.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        found, which = [], []
        first = np.searchsorted(self.hash, words.hash)
        for j in range(self.depth):
            at = np.minimum(first + j, len(self.hash) - 1)
            i = np.flatnonzero(self.hash[at] == words.hash)
            t = self.term[at[i]]
            ok = self._equal(words, i, t)
            found.append(i[ok])
            which.append(t[ok])
        return np.concatenate(found), np.concatenate(which)

    def _equal(self, words: Words, i: np.ndarray, t: np.ndarray) -> np.ndarray:
        lens = words.ends[i] - words.starts[i]
        ok = lens == self.offsets[t + 1] - self.offsets[t]
        i, t, lens = i[ok], t[ok], lens[ok]
        if len(i):
            at = np.concatenate([[0], np.cumsum(lens)[:-1]])
            pos = np.arange(int(lens.sum())) - np.repeat(at, lens)
            same = words.low[np.repeat(words.starts[i], lens) + pos] == self.raw[np.repeat(self.offsets[t], lens) + pos]
            ok[np.flatnonzero(ok)] = np.logical_and.reduceat(same, at)
        return ok


def _blobs(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column: row i holds the next counts[i] values."""
    width = values.dtype.itemsize
    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]) * width
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(
        np.ascontiguousarray(values).tobytes())]).cast(pa.binary())


def _unblob(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets in values) of such a column."""
    raw, offsets = utf8(column)
    return np.frombuffer(raw.tobytes(), kind), offsets // np.dtype(kind).itemsize


def term_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n (words), terms (int32), tf (int32) of every document."""
    size = len(vocabulary)

    def block(words):
        i, t = vocabulary.places(words)
        return np.unique(words.doc[i] * np.int64(max(size, 1)) + t, return_counts=True)

    def scan(batches):
        for b in text_blocks(batches, "text"):
            raw, offsets = utf8(b.column("text"))
            if b.num_rows > 1 or len(raw) <= PIECE:
                words = Words(raw, offsets)
                n, (pair, tf) = words.count, block(words)
            else:
                n, total = np.zeros(1, np.int64), np.zeros(size, np.int64)
                cuts = word_cuts(raw, PIECE)
                for x, y in zip(cuts, cuts[1:]):
                    words = Words(raw[x:y], np.array([0, y - x]))
                    n += len(words.hash)
                    pair, tf = block(words)
                    total[pair] += tf
                pair = np.flatnonzero(total)
                tf = total[pair]
            doc, term = np.divmod(pair, max(size, 1))
            counts = np.bincount(doc, minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n.astype(np.int64)), _blobs(term.astype(np.int32), counts), _blobs(tf.astype(np.int32), counts)],
                names=["doc_id", "n", "terms", "tf"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(rows.mapInArrow(scan, "doc_id long, n long, terms binary, tf binary"), "term-counts")


def document_frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term: summed in every task, then over the tasks."""

    def add(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(_unblob(b.column("terms"), np.int32)[0], minlength=size)
        t = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(t.astype(np.int32)), pa.array(total[t])], names=["t", "df"])

    out = np.zeros(size, np.int64)
    rows = counts.select("terms").mapInArrow(add, "t int, df long").groupBy("t").agg(F.sum("df").alias("df"))
    for r in rows.collect():  # at most the vocabulary
        out[r["t"]] = r["df"]
    return out


def impact_vectors(counts: DataFrame, weights: np.ndarray, n_docs: int, n_words: int) -> DataFrame:
    """doc_id, norm, terms, impacts (int32), sorted by norm (largest first) in a table."""
    root = np.sqrt(weights.astype(np.float64))

    def impacts(batches):
        for b in batches:
            term, offsets = _unblob(b.column("terms"), np.int32)
            tf = _unblob(b.column("tf"), np.int32)[0].astype(np.int64)
            m = 10 + (90 * b.column("n").to_numpy() * n_docs) // n_words
            each = np.diff(offsets)
            value = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, each))
            scaled = (root[term] * value) ** 2
            sums = np.concatenate([[0.0], np.cumsum(scaled)])
            # a cumulative sum's error is relative to the whole block, so the norm is rounded up
            norm = np.sqrt((sums[offsets[1:]] - sums[offsets[:-1]]) + sums[-1] * 1e-12)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(norm), b.column("terms"), _blobs(value.astype(np.int32), each)],
                                             names=["doc_id", "norm", "terms", "impacts"])

    rows = counts.where(F.length("terms") > 0).mapInArrow(impacts, "doc_id long, norm double, terms binary, impacts binary")
    return range_sorted(rows, [F.desc("norm")], "impact-vectors")


class Queries:
    """A block's queries as dense rows over the vocabulary."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray):
        self.terms = [t[weights[t] > 0] for t in terms]
        self.root = np.sqrt(weights.astype(np.float64))
        self.weights = weights
        self.norm = np.array([math.sqrt(float(weights[t].sum())) for t in self.terms])
        self.focus, self.rest = [], []
        for t in self.terms:
            order = t[np.argsort(-weights[t], kind="stable")]
            self.focus.append(order[:FOCUS])
            self.rest.append(math.sqrt(float(weights[order[FOCUS:]].sum())))


def _merge(best: list, score: np.ndarray, ids: list, k: int) -> list:
    """The k best (score, doc_id) of ``best`` and new ones; ties to the smaller id, null last."""
    rows = best + list(zip(score.tolist(), ids))
    rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    return rows[:k]


def _search_bucket(queries: Queries, norms, term, offsets, impact, doc_ids, best, floor, k):
    """Search one bucket (norms descending) for all queries; ``best`` and ``floor`` are updated."""
    active = np.flatnonzero((queries.norm * norms[0] * (1 + _SLACK) >= floor) & (queries.norm > 0))
    if not len(active):
        return
    owner = np.repeat(np.arange(len(norms)), np.diff(offsets))
    order = np.argsort(term, kind="stable")  # the inverted lists of the bucket
    by_term, by_owner, by_impact = term[order], owner[order], impact[order].astype(np.float64)
    used = np.zeros(len(queries.weights), np.int64)
    for q in active.tolist():
        dots, squares = np.zeros(len(norms)), np.zeros(len(norms))
        focus = queries.focus[q]
        lo, hi = np.searchsorted(by_term, focus), np.searchsorted(by_term, focus, side="right")
        for t, a, b in zip(focus.tolist(), lo.tolist(), hi.tolist()):
            if b > a:  # a document is at most once in a list
                value = by_impact[a:b] * queries.root[t]
                dots[by_owner[a:b]] += value * queries.root[t]
                squares[by_owner[a:b]] += value * value
        left = np.sqrt(np.maximum(norms * norms * (1 + _SLACK) - squares, 0.0))
        keep = np.flatnonzero((dots + queries.rest[q] * left) * (1 + _SLACK) >= max(floor[q], 1))
        if not len(keep):
            continue
        used[queries.terms[q]] = queries.weights[queries.terms[q]]
        each = offsets[keep + 1] - offsets[keep]
        at = np.concatenate([[0], np.cumsum(each)[:-1]])
        place = np.arange(int(each.sum())) - np.repeat(at - offsets[keep], each)
        score = np.add.reduceat(used[term[place]] * impact[place].astype(np.int64), at)
        used[queries.terms[q]] = 0
        good = np.flatnonzero(score >= max(floor[q], 1))
        if len(good) > k:  # only those that can be among the k best of this bucket
            least = np.partition(score[good], len(good) - k)[len(good) - k]
            good = good[score[good] >= least]
        if len(good):
            best[q] = _merge(best[q], score[good], [doc_ids[i] for i in keep[good].tolist()], k)
            if len(best[q]) == k:
                floor[q] = max(floor[q], best[q][-1][0])


def search_round(vectors: DataFrame, queries: Queries, floor: np.ndarray, k: int) -> DataFrame:
    """q, score, doc_id: each task's best for every query, from ``floor`` on."""

    def search(batches):
        best: list[list] = [[] for _ in queries.terms]
        least = floor.copy()
        for whole in batches:
            for at in range(0, whole.num_rows, BUCKET):
                b = whole.slice(at, BUCKET)
                term, offsets = _unblob(b.column("terms"), np.int32)
                impact = _unblob(b.column("impacts"), np.int32)[0]
                _search_bucket(queries, b.column("norm").to_numpy(), term, offsets, impact, b.column("doc_id").to_pylist(), best, least, k)
        rows = [(q, s, i) for q, x in enumerate(best) for s, i in x if s >= least[q]]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                                         names=["q", "score", "doc_id"])

    return vectors.select("norm", "terms", "impacts", "doc_id").mapInArrow(search, _TOP)


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _cuts(vectors: DataFrame, shares=ROUNDS) -> list[float]:
    """Norms down to which the rounds go, from the partitions' sizes and ranges."""
    rows = vectors.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.min("norm").alias("low")).orderBy(F.desc("low")).collect()
    total, seen, out = sum(r["n"] for r in rows), 0, []
    todo = list(shares)
    for r in rows:
        seen += r["n"]
        if todo and seen >= todo[0] * total:
            out.append(r["low"])
            todo = [s for s in todo if s * total > seen]
    return out


def search_block(docs: DataFrame, block: list, k: int) -> DataFrame:
    """key, rank, doc_id, score of the queries (rows with key and terms) over all documents."""
    spark = docs.sparkSession
    schema = "key string, rank int, doc_id long, score long"
    terms = sorted({t for r in block for t in r["terms"]})
    vocabulary = Vocabulary(terms)
    counts = term_counts(docs, vocabulary)
    one = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    if not one["words"]:
        return spark.createDataFrame([], schema)
    df = document_frequencies(counts, len(vocabulary)).tolist()
    weights = np.array([math.floor(1000 * math.log((2 * one["docs"] + 2) / (2 * x + 1))) for x in df], np.int64)
    vectors = impact_vectors(counts, weights, one["docs"], one["words"])
    place = {t: i for i, t in enumerate(terms)}
    queries = Queries([np.array([place[t] for t in r["terms"]], np.int32) for r in block], weights)
    floor = np.zeros(len(block), np.int64)
    above, found = None, None
    for low in [*_cuts(vectors), None]:
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(queries.norm > 0, floor / queries.norm, np.inf).min() * (1 - _SLACK)
        part = vectors.where(F.col("norm") >= float(least)) if np.isfinite(least) else vectors.limit(0)
        part = part if above is None else part.where(F.col("norm") < above)
        part = part if low is None else part.where(F.col("norm") >= low)
        rows = search_round(part, queries, floor, k)
        found = rows if found is None else found.unionByName(rows)
        found = materialise(_ranked(found, k).select("q", "score", "doc_id"), "top")
        if low is not None:
            for r in found.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(F.col("n") >= k).collect():
                floor[r["q"]] = r["s"]  # a row for each query of the block
        above = low
    keys = F.array(*[F.lit(r["key"]) for r in block])
    return _ranked(found, k).select(F.get(keys, F.col("q")).alias("key"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, max_terms: int = MAX_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    asked = materialise(item_queries(items), "items")
    texts = asked.select("key", "terms").distinct()
    total = texts.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-int(total) // max_terms))
    texts = materialise(texts.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))), "item-terms") if blocks > 1 else texts.withColumn(
        "block", F.lit(0))
    out = None
    for i in range(blocks):
        block = texts.where(F.col("block") == i).orderBy("key").collect()  # about max_terms terms
        if block:
            found = search_block(docs, block, k)
            out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "key string, rank int, doc_id long, score long").join(
            asked, "key").select("item_id", "rank", "doc_id", "score")
    return asked.select("key", "item_id").join(out, "key").select("item_id", "rank", "doc_id", "score")
