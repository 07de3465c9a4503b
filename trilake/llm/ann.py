"""Approximate nearest neighbours by NN-descent and greedy graph search.

1. Equal vectors become one node (their smallest id); the others are its members. Graph,
   search and final scores all compare the original vectors in double precision, so near
   copies keep their order.
2. Start: nodes are sorted by the Gray rank of random hyperplane signs, several times, and
   neighbours in blocks of that order are compared. Nodes with equal signs (near copies)
   are sorted by a random projection, another one each time.
3. NN-descent, one Spark join a round: every node's neighbours (its own and those that
   chose it, the ``width`` closest) meet under the node and are compared with each other, so
   neighbours of neighbours find each other; each node keeps its ``degree`` best. Only pairs
   with a neighbour that is new under this node are compared: the ids are matched with the
   last round's first, and vectors are sent only to nodes that have a new neighbour. (Of two
   old ones the pair was compared before, and what a list asks for only rises, so it would
   be refused again.) Rounds end when few list entries are new; there is no fixed number.
4. Search: a query starts at its own node or given entry nodes and their neighbours. In each
   round all nodes of its beam that it has not opened yet are opened: their neighbours are
   scored, and the ``beam`` closest stay. It ends when all nodes in every beam are opened. Scoring is done
   in blocks of nodes (at most ``SEARCH_BYTES`` of vectors each, more blocks for more
   nodes), so a node's vector moves once a round.
5. The best nodes' members (the smallest ids of each) are scored exactly and ranked.

A node that many choose is cut to its closest in every task before it is shuffled; the
lists it leaves are still in the other nodes' own. All rows are indexed. Lists are cut by
windows; only what compares vectors runs in Python, one stage a round.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, nor
do rows without an id; of rows that share an id the smallest vector counts; vectors whose
length differs from the index's (the most common one) take no part; fewer candidates than
asked for: all; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window, functions as F

from .common import materialise, whole_groups

DEGREE = 28
WIDTH = 40
STARTS = 12
START_BLOCK = 512
#: Rounds end when at most this share of all list entries is new.
FEW = 0.002
BEAM = 160
#: Vector bytes of a block of nodes in the search.
SEARCH_BYTES = 1 << 20
#: Pairs that a block scores at a time.
SEARCH_PAIRS = 1 << 15
#: Digits of a score; more would rank the rounding of the sums.
DIGITS = 14
#: ``new`` is 1 for an edge that this round has found.
_EDGES = "a long, b long, s double, new int"


def _vectors(binary: pa.Array, scale: pa.Array) -> np.ndarray:
    """float64 rows of unit length."""
    if not len(binary):
        return np.zeros((0, 1))
    rows = np.frombuffer(b"".join(binary.to_pylist()), np.float32).reshape(len(binary), -1)
    return rows * scale.to_numpy()[:, None]


def _best(a, b, s, new, n):
    """The n largest s of each a (ties to the smaller b), each (a, b) once (the old one if
    there is); sorted."""
    order = np.lexsort((-s, new, b, a))
    a, b, s, new = a[order], b[order], s[order], new[order]
    once = np.ones(len(a), bool)
    once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b, s, new = a[once], b[once], s[once], new[once]
    order = np.lexsort((b, -s, a))
    a, b, s, new = a[order], b[order], s[order], new[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    place = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
    keep = place < n
    return a[keep], b[keep], s[keep], new[keep]


def _edge_batch(a, b, s, new=None):
    new = np.ones(len(a), np.int32) if new is None else new
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s.astype(np.float64)), pa.array(new.astype(np.int32))],
                                      names=["a", "b", "s", "new"])


def _cut(parts, n: int):
    """Batches of the n best of each a in edges (a, b, s, new) that a task makes bit by bit."""
    held, rows = [], 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows >= 500_000:
            yield _edge_batch(*_best(*(np.concatenate(c) for c in zip(*held)), n))
            held, rows = [], 0
    if rows:
        yield _edge_batch(*_best(*(np.concatenate(c) for c in zip(*held)), n))


def _best_pairs(edges: DataFrame, n: int) -> DataFrame:
    """``_best`` of edges that are dealt out by a."""
    old = F.max(F.when(F.col("new") == 0, F.col("s")))
    once = edges.groupBy("a", "b").agg(F.coalesce(old, F.max("s")).alias("s"), F.min("new").alias("new"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))
    return once.withColumn("_place", place).where(F.col("_place") <= n).select("a", "b", "s", "new")


def _top(edges: DataFrame, n: int) -> DataFrame:
    """(a, b, s, new): the n best of each a."""
    return _best_pairs(edges.select("a", "b", "s", "new").repartition("a"), n)


# -- vectors ---------------------------------------------------------------------------

def clean_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, v (array of float) of the rows that take part, one for each id."""
    v = F.col(vector).cast("array<float>")
    rows = table.select(F.col(key).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null and size(v) > 0")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= 3.4028235e38))
    rows = rows.where(whole).where(F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").limit(1)
    return rows.where(F.size("v") == common.select("n").scalar()).groupBy("id").agg(F.min("v").alias("v"))


def nodes_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: a, v, q (its bytes), scale (1 / its length); members: a, id) of the vectors (id, v)."""
    groups = rows.groupBy("v").agg(F.min("id").alias("a"))

    def pack(batches):
        for b in batches:
            v = b.column("v")
            x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(v), -1) if len(v) else np.zeros((0, 1), np.float32)
            scale = 1 / np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), v, pa.array([r.tobytes() for r in x], pa.binary()), pa.array(scale)], names=["a", "v", "q", "scale"])

    nodes = materialise(groups.select("a", "v").mapInArrow(pack, "a long, v array<float>, q binary, scale double"), "nodes")
    members = rows.join(nodes.select("a", F.col("v").alias("_v")), F.col("v") == F.col("_v")).select("a", "id")
    return nodes, members


# -- graph -----------------------------------------------------------------------------

def _start(nodes: DataFrame, degree: int, starts: int, block: int) -> DataFrame:
    """Edges between neighbours in blocks of several random sign orders."""
    from .simhash import gray_rank

    def order(batches):
        for b in batches:
            x = _vectors(b.column("q"), b.column("scale"))
            for t in range(starts):
                planes = np.random.default_rng(1000 + t).standard_normal((x.shape[1], 32))
                side, planes = x @ planes[:, 31], planes[:, :31]
                code = ((x @ planes > 0).astype(np.uint64) << np.arange(30, -1, -1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b.num_rows, t, np.int32)), pa.array(gray_rank(code).astype(np.int64)), pa.array(side),
                     b.column("a"), b.column("q"), b.column("scale")], names=["t", "rank", "side", "a", "q", "scale"])

    rows = nodes.select("a", "q", "scale").mapInArrow(order, "t int, rank long, side double, a long, q binary, scale double")

    def compare(batches):
        held, n = [], 0

        def blocks(table):
            # blocks of about the same size that do not cross an order
            t = table.column("t").to_numpy()
            for part in np.split(np.arange(len(t)), np.flatnonzero(t[1:] != t[:-1]) + 1):
                for ix in np.array_split(part, max(1, len(part) // block)):
                    x = _vectors(table.column("q").slice(ix[0], len(ix)), table.column("scale").slice(ix[0], len(ix)))
                    a = table.column("a").to_numpy()[ix]
                    s = np.round(x @ x.T, DIGITS)
                    np.fill_diagonal(s, -2)
                    k = min(degree, len(ix) - 1)
                    if k > 0:
                        best = np.argpartition(-s, k - 1, axis=1)[:, :k]
                        yield _edge_batch(np.repeat(a, k), a[best].ravel(), np.take_along_axis(s, best, 1).ravel())

        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= 16 * block:
                yield from blocks(pa.Table.from_batches(held).combine_chunks())
                held, n = [], 0
        if n:
            yield from blocks(pa.Table.from_batches(held).combine_chunks())

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, "t", "rank", "side", "a").sortWithinPartitions("t", "rank", "side", "a").mapInArrow(compare, _EDGES)


def _local_joins(near: DataFrame, degree: int) -> DataFrame:
    """Better edges among each owner's neighbours, at least one of a pair new: near has owner,
    a, new, q, scale, least."""

    def compare(batches):
        for t in whole_groups(batches, ["owner"], 16_384):
            owner, a, fresh, least = (t.column(c).to_numpy() for c in ("owner", "a", "new", "least"))
            x = _vectors(t.column("q"), t.column("scale"))
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(np.append(first, len(owner)))
            out = []
            for g in np.array_split(np.arange(len(first)), max(1, len(first) // 128)):
                width = int(size[g].max())
                at = first[g][:, None] + np.arange(width)
                real = np.arange(width) < size[g][:, None]
                at = np.where(real, at, 0)
                m = x[at]
                s = np.round(m @ m.transpose(0, 2, 1), DIGITS)
                new = fresh[at] == 1
                better = (s > least[at][:, :, None]) & real[:, :, None] & real[:, None, :] & (a[at][:, :, None] != a[at][:, None, :])
                better &= new[:, :, None] | new[:, None, :]
                p, i, j = np.nonzero(better)
                out.append((a[at[p, i]], a[at[p, j]], s[p, i, j]))
            a, b, s = (np.concatenate(c) for c in zip(*out))
            yield _best(a, b, s, np.ones(len(a), np.int32), degree)

    return near.select("owner", "a", "new", "q", "scale", "least").repartition("owner").sortWithinPartitions("owner").mapInArrow(
        lambda batches: _cut(compare(batches), degree), _EDGES)


def _adjacency(graph: DataFrame, width: int) -> DataFrame:
    """The ``width`` closest neighbours of each node, in either direction. A pair stands in the
    union at most twice, so no task passes on more than twice as many of a node."""
    both = graph.select("a", "b", "s", "new").union(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "s", "new"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b", "new"))
    return _best_pairs(both.withColumn("_place", place).where(F.col("_place") <= 2 * width).drop("_place"), width)


def _who_is_new(around: DataFrame, met: DataFrame | None) -> DataFrame:
    """owner, a, new of the owners' neighbours; new is 0 for those in ``met``, the neighbours
    of the round before."""
    if met is None:
        return around.withColumn("new", F.lit(1))
    met = met.select("owner", "a", F.lit(0).alias("new"))
    return around.join(met, ["owner", "a"], "left").select("owner", "a", F.coalesce("new", F.lit(1)).alias("new"))


def build_graph(nodes: DataFrame, degree: int = DEGREE, width: int = WIDTH, starts: int = STARTS, block: int = START_BLOCK,
                few: float = FEW) -> DataFrame:
    """a, b, s, new: the neighbour graph of the nodes."""
    graph = materialise(_top(_start(nodes, degree, starts, block), degree), "graph")
    code = nodes.select("a", "q", "scale")
    met = None
    while True:
        least = graph.groupBy("a").agg(F.when(F.count(F.lit(1)) >= degree, F.min("s")).otherwise(F.lit(-2.0)).alias("least"))
        member = code.join(least, "a", "left").withColumn("least", F.coalesce("least", F.lit(-2.0)))
        around = _adjacency(graph, width).select(F.col("a").alias("owner"), F.col("b").alias("a"))
        around = around.union(code.select(F.col("a").alias("owner"), "a"))
        met = materialise(_who_is_new(around, met), "around")
        live = met.where("new = 1").select("owner").distinct()
        found = _local_joins(met.join(live, "owner", "left_semi").join(member, "a"), degree)
        graph = materialise(_top(graph.withColumn("new", F.lit(0)).union(found), degree), "graph")
        total, new = graph.agg(F.count(F.lit(1)), F.coalesce(F.sum("new"), F.lit(0))).first()
        if new <= few * total:
            return graph


# -- search ----------------------------------------------------------------------------

def search(nodes: DataFrame, graph: DataFrame, entries: DataFrame, beam: int = BEAM,
           width: int = WIDTH) -> DataFrame:
    """query, b, s: the closest nodes found for each query; ``entries`` has query, q, scale
    (its vector) and entry (an array of nodes to start from)."""
    spark = nodes.sparkSession
    one = nodes.select(F.length("q").alias("n")).first()
    size = nodes.count() * one.n if one else 0
    n_blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SEARCH_BYTES))
    around = materialise(_adjacency(graph, width).groupBy("a").agg(F.collect_list("b").alias("around")), "adjacency")
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(n_blocks)).cast("int")
    place = nodes.select(block("a").alias("block"), "a", "q", "scale")
    asked = materialise(entries.select(F.col("query").alias("a"), "q", "scale"), "queries")

    def scores(pairs: pa.Table, vectors: pa.Table) -> pa.Table:
        x = _vectors(vectors.column("q").combine_chunks(), vectors.column("scale"))
        ids = vectors.column("a").to_numpy()
        if not len(ids):
            return pa.Table.from_batches([_edge_batch(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))])
        order = np.argsort(ids)
        pairs = pairs.combine_chunks()
        query, least = (pairs.column(c).to_numpy() for c in ("a", "least"))
        lists = pairs.column("cand").combine_chunks()
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)
        cands = lists.flatten().to_numpy()
        out, row = [], 0
        while row < len(query):  # whole queries, about SEARCH_PAIRS candidates
            base = ends[row - 1] if row else 0
            to = max(row + 1, int(np.searchsorted(ends, base + SEARCH_PAIRS, side="right")))
            own = _vectors(pairs.column("q").slice(row, to - row), pairs.column("scale").slice(row, to - row))
            cand = cands[base:ends[to - 1]]
            of = np.repeat(np.arange(row, to), np.diff(ends[row:to], prepend=base))
            at = order[np.minimum(np.searchsorted(ids, cand, sorter=order), len(ids) - 1)]
            hit = ids[at] == cand
            at, cand, of = at[hit], cand[hit], of[hit]
            # summed row by row: a pair's score is the same in every round
            s = np.round((x[at] * own[of - row]).sum(axis=1), DIGITS)
            keep = s >= least[of]
            out.append((query[of[keep]], cand[keep], s[keep]))
            row = to
        a, b, s = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        return pa.Table.from_batches([_edge_batch(a, b, s)])

    def score(pairs: DataFrame, least: DataFrame) -> DataFrame:
        by_block = pairs.groupBy("a", block("b").alias("block")).agg(F.collect_set("b").alias("cand"))
        by_block = by_block.join(asked, "a").join(least, "a", "left").select(
            "block", "a", "q", "scale", F.coalesce("least", F.lit(-2.0)).alias("least"), "cand")
        return by_block.groupBy("block").cogroup(place.groupBy("block")).applyInArrow(scores, _EDGES)

    def opened(pairs: DataFrame) -> DataFrame:
        return pairs.join(around.withColumnRenamed("a", "b"), "b").select("a", F.explode("around").alias("b"))

    def beams(edges: DataFrame) -> tuple[DataFrame, int]:
        seen = Observation(f"beam-{uuid.uuid4().hex}")
        out = materialise(_top(edges, beam).observe(seen, F.count_if(F.col("new") == 1).alias("new")), "beam")
        return out, seen.get["new"]

    # the entry nodes are scored and opened at once
    first = entries.select(F.col("query").alias("a"), F.explode("entry").alias("b"))
    none = spark.createDataFrame([], "a long, least double")
    found, new = beams(score(first.union(opened(first)), none))
    while new:
        reach = opened(found.where("new = 1").select("a", "b"))
        least = found.groupBy("a").agg(F.when(F.count(F.lit(1)) >= beam, F.min("s")).alias("least"))
        # every node that was in the beam has been opened by now
        found, new = beams(found.withColumn("new", F.lit(0)).union(score(reach, least)))
    return found.select(F.col("a").alias("query"), "b", "s")


def nearest(table: DataFrame, queries: DataFrame, k: int = 5, keep: int = 32, **how) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each of ``queries``
    (vec_id, ids of rows in the table), the row itself left out."""
    graph_how = {x: how[x] for x in ("degree", "width", "starts", "block", "few") if x in how}
    search_how = {x: how[x] for x in ("beam", "width") if x in how}
    rows = materialise(clean_vectors(table), "vectors")
    nodes, members = nodes_of(rows)
    members = materialise(members, "members")
    graph = build_graph(nodes, **graph_how)
    asked = members.join(queries.select(F.col("vec_id").cast("long").alias("id")).distinct(), "id")  # a, id
    entries = nodes.join(asked.select("a").distinct(), "a", "left_semi").select(
        F.col("a").alias("query"), "q", "scale", F.array("a").alias("entry"))
    found = search(nodes, graph, entries, **search_how)
    rank = Window.partitionBy("query").orderBy(F.desc("s"), "b")
    close = found.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= keep).select(F.col("query").alias("a"), "b")
    # exact scores on the original vectors, once for each pair of nodes
    v = nodes.select("a", "v")
    pairs = close.join(v, "a").join(v.select(F.col("a").alias("b"), F.col("v").alias("w")), "b").select("a", "b", "v", "w")

    def exact(batches):
        for t in batches:
            v, w = (t.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(t.num_rows, -1) for c in ("v", "w")) \
                if t.num_rows else (np.zeros((0, 1)),) * 2
            s = (v * w).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((w * w).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b"), pa.array(s)], names=["a", "b", "score"])

    scored = pairs.mapInArrow(exact, "a long, b long, score double")
    few = members.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy("id"))).where(F.col("r") <= k + 1)
    out = asked.join(scored, "a").join(few.select(F.col("a").alias("b"), F.col("id").alias("vec_id")), "b").where("vec_id <> id")
    best = Window.partitionBy("id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
