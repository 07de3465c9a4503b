"""Toxicity: a counterfactual-regularised linear classifier.

1. Training rows: at most ``max_rows`` labelled documents, taken by the hash of their id
   (the documented bound; every labelled row has the same chance). Held-out rows never
   take part.
2. Features: presence of hashed words and of their first 4 and 5 bytes, so endings of a
   stem share evidence. Counts per class choose at most ``max_features`` of them.
3. Counterfactuals: in each labelled text that names a group, every identity term is
   swapped for the next one of its set. Logistic regression (features scaled by their log
   odds) minimises the log loss, an L2 term, and ``pull`` times the squared change of the
   text's score under the swap. So what a label says about a text cannot be explained by
   *which* group it names, and neutral mentions keep a neutral score.
4. Scoring is one scan of all documents with the weights (a fixed-size table).

Cases: null and empty texts get the score of a text without features; null doc_ids are
scored and never trained on; of several labels of an id the toxic one counts, null labels
are ignored; repeated rows are scored each; without labels, or with one class only, all
scores are the smoothed base rate; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Words, materialise, mix, text_blocks, utf8, word_cuts

#: Labelled documents that the classifier is fitted on, at most.
MAX_ROWS = 20_000
#: Chosen features, at most, and the least certainty of their log odds (in standard errors).
MAX_FEATURES = 5_000
LEAST_SURE = 3.0
#: Hash places of features.
PLACES = 1 << 20
PREFIXES = (4, 5)
THRESHOLD = 0.3
PIECE = 1 << 22

#: Sets of identity terms; a swap replaces a term by the next of its set.
IDENTITY_SETS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"), ("girl", "boy"), ("she", "he"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "arab"), ("africans", "europeans", "asians", "americans"),
    ("immigrants", "natives"), ("immigrant", "native"), ("refugees", "citizens"), ("old", "young"), ("elderly", "youth"),
    ("disabled", "abled"), ("deaf", "hearing"), ("blind", "sighted"), ("poor", "rich"),
    ("frauen", "männer"), ("frau", "mann"), ("femmes", "hommes"), ("femme", "homme"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmans", "chrétiens", "juifs"), ("musulmanes", "cristianos", "judíos"),
    ("muslime", "christen", "juden"),
)


def held_out(doc_id):
    """Rows that must not be learned from."""
    return F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 4 == 2


def _word_features(words: Words) -> np.ndarray:
    """(words, 1 + prefixes) places of each word's features."""
    columns = [words.hash, *words.prefix]
    return np.stack([(mix(h + np.uint64(i)) % np.uint64(PLACES)).astype(np.int64) for i, h in enumerate(columns)], axis=1) \
        if len(words.hash) else np.zeros((0, len(columns)), np.int64)


def _swaps() -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes of identity terms, the places of the next term of its set)."""
    pairs = {}
    for terms in IDENTITY_SETS:
        for term, other in zip(terms, (*terms[1:], terms[0])):
            own, to = (Words(*utf8(pa.array([t])), PREFIXES) for t in (term, other))
            pairs.setdefault(int(own.hash[0]), _word_features(to)[0])
    keys = np.array(sorted(pairs), np.uint64)
    return keys, np.stack([pairs[int(k)] for k in keys])


def text_features(block: pa.RecordBatch, swaps=None):
    """(text, place) pairs of the block's texts, each once; with ``swaps`` also the pairs of
    the swapped texts, for texts that name a group."""
    raw, offsets = utf8(block.column("text"))
    cuts = word_cuts(raw, PIECE) if block.num_rows == 1 else None
    pairs, other, named = [], [], []
    for a, b in zip(cuts, cuts[1:]) if cuts else [(0, len(raw))]:
        words = Words(raw[a:b], np.array([0, b - a]) if cuts else offsets, PREFIXES)
        places = _word_features(words)
        base = words.doc[:, None] * PLACES
        pairs.append(np.unique(base + places))
        if swaps is not None and len(words.hash):
            keys, to = swaps
            at = np.minimum(np.searchsorted(keys, words.hash), len(keys) - 1)
            hit = keys[at] == words.hash
            other.append(np.unique(base + np.where(hit[:, None], to[at], places)))
            named.append(np.unique(words.doc[hit]))
    pairs = np.unique(np.concatenate(pairs))
    if swaps is None:
        return pairs
    if not other:
        return pairs, pairs[:0]
    other = np.unique(np.concatenate(other))
    return pairs, other[np.isin(other // PLACES, np.concatenate(named))]


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, text: str) -> DataFrame:
    """text, y of at most ``max_rows`` labelled documents that are not held out; of documents
    that share an id the one with the smallest text hash."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("y"))
    share = 0.97 * max_rows / max(known.count(), 1)
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = F.broadcast(known.limit(max_rows))  # at most max_rows pairs of numbers
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(sample, "doc_id")
    return own.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "y")).alias("d")).select("d.text", "d.y")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES,
        pull: float = 1.0, ridge: float = 1e-5, steps: int = 250, text: str = "text") -> tuple[np.ndarray, float]:
    """(weights by place, bias)."""

    def features(batches):
        swaps = _swaps()
        for block in text_blocks(batches, "text"):
            pairs, other = text_features(block, swaps)
            def lists(x):
                ends = np.searchsorted(x, np.arange(block.num_rows + 1) * PLACES)
                return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array((x % PLACES).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([block.column("y"), lists(pairs), lists(other)], names=["y", "f", "g"])

    rows = materialise(training_rows(docs, labels, max_rows, text).mapInArrow(
        features, "y int, f array<int>, g array<int>"), "toxicity-features")

    def counts(batches):
        n = np.zeros((2, PLACES), np.int64)
        for b in batches:
            f = b.column("f")
            y = np.repeat(b.column("y").to_numpy(), f.value_lengths().to_numpy())
            for label in (0, 1):
                n[label] += np.bincount(f.flatten().to_numpy()[y == label], minlength=PLACES)
        at = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[0, at]), pa.array(n[1, at])], names=["p", "n0", "n1"])

    total = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    t0, t1 = total.get(0, 0), total.get(1, 0)
    weights, bias = np.zeros(PLACES), float(np.log((t1 + 0.5) / (t0 + 0.5))) if t0 + t1 else -2.0
    if not t0 or not t1:
        return weights, bias
    odds = F.log((F.col("n1") + 0.5) / (t1 + 1.0)) - F.log((F.col("n0") + 0.5) / (t0 + 1.0))
    sure = F.abs(odds) / F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    best = rows.mapInArrow(counts, "p int, n0 long, n1 long").groupBy("p").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(
        "n0 + n1 >= 3").where(sure >= LEAST_SURE).select("p", odds.alias("odds"), sure.alias("sure")).orderBy(F.desc("sure"), "p").limit(max_features).toPandas()
    chosen = np.full(PLACES, -1, np.int32)
    chosen[best["p"].to_numpy()] = np.arange(len(best))

    def keep(batches):
        for b in batches:
            out = [b.column("y")]
            for c in ("f", "g"):
                f = b.column(c)
                v = chosen[f.flatten().to_numpy()]
                row = np.repeat(np.arange(b.num_rows), f.value_lengths().to_numpy())[v >= 0]
                ends = np.searchsorted(row, np.arange(b.num_rows + 1))
                out.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(v[v >= 0])))
            yield pa.RecordBatch.from_arrays(out, names=["y", "f", "g"])

    table = rows.mapInArrow(keep, "y int, f array<int>, g array<int>").toArrow().combine_chunks()
    scale = np.clip(best["odds"].to_numpy(), -6, 6)
    w, bias = _regress(table, scale, bias, pull, ridge, steps)
    weights[best["p"].to_numpy()] = w * scale
    return weights, bias


def _regress(table: pa.Table, scale: np.ndarray, bias: float, pull: float, ridge: float, steps: int):
    """Logistic regression with the counterfactual term, by Adam on all rows."""
    y = table.column("y").to_numpy().astype(float)
    n, m = len(y), len(scale)

    def pairs(name):
        f = table.column(name).combine_chunks()
        f = f.chunk(0) if isinstance(f, pa.ChunkedArray) else f
        return np.repeat(np.arange(n), f.value_lengths().to_numpy()), f.flatten().to_numpy()

    row, at = pairs("f")
    row2, at2 = pairs("g")
    named = np.zeros(n, bool)
    named[row2] = True
    own = named[row]
    change_row = np.concatenate([row[own], row2])  # the text's features less the swapped text's
    change_at = np.concatenate([at[own], at2])
    sign = np.concatenate([np.ones(int(own.sum())), -np.ones(len(row2))])
    w, b, v, s = np.ones(m) * 0.1, bias, np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, steps + 1):
        x = w * scale
        z = b + np.bincount(row, x[at], n)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        shift = np.bincount(change_row, sign * x[change_at], n)
        grad = (np.bincount(at, error[row], m) + 2 * pull * np.bincount(change_at, sign * shift[change_row], m)) * scale / n
        grad = np.append(grad + 2 * ridge * w, error.mean())
        v, s = 0.9 * v + 0.1 * grad, 0.999 * s + 0.001 * grad * grad
        move = 0.1 * (v / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


def _scores(block: pa.RecordBatch, w: np.ndarray, bias: float) -> np.ndarray:
    """Scores of a block's texts (its column ``text``)."""
    pairs = text_features(block)
    z = bias + np.bincount(pairs // PLACES, w[pairs % PLACES], block.num_rows)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, weights: np.ndarray, bias: float, text: str = "text") -> DataFrame:
    """doc_id, _th and score of every document."""
    w = weights.astype(np.float32)

    def scan(batches):
        for block in text_blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("_th"), pa.array(_scores(block, w, bias))],
                                             names=["doc_id", "_th", "score"])

    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(t).alias("_th"), t.alias("text"))
    return rows.mapInArrow(scan, "doc_id long, _th long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", **how) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    weights, bias = fit(docs, labels, text=text, **how)
    return score(docs, weights, bias, text).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` without those that score at the threshold or above."""
    weights, bias = fit(docs, labels, text=text, **how)
    w, names, schema = weights.astype(np.float32), docs.columns, docs.schema

    def scan(batches):
        for block in text_blocks(batches, text):
            yield block.filter(pa.array(_scores(block.select([text]).rename_columns(["text"]), w, bias) < THRESHOLD))

    return docs.mapInArrow(scan, schema)
