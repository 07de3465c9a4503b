"""Centroid clustering with heap-ordered bounds.

Exact k-means over integer vectors. A vector in cluster ``a`` has an upper bound of the
distance to its own centroid and a lower bound of that to every other one. When centroids
move, their *gap* (lower - upper) shrinks by at most own drift + largest other drift, the
same number for all vectors of the cluster. So nothing is updated per vector: each cluster
has an offset (its drift so far), an entry is pushed with the key ``gap + offset``, and it
has expired once the cluster's offset reaches its key.

The heaps are tables: a round's entries are written sorted by (cluster, key), so the expired
ones are a prefix of each cluster in every file, and the parquet statistics skip the rest.
A round

1. pops the entries whose key lies between the last and the present offset of their cluster,
   in all tables written so far. Keys below the last offset were popped before, so nothing
   is ever deleted or rewritten;
2. scans exactly those against all centroids and pushes them into the round's own table;
3. adds the vectors that changed their cluster to the new cluster's sum and takes them from
   the old one's (64-bit integers, so centroids are exact).

Only the centroids (k vectors) reach the driver. Bounds are kept a little too tight
(``_SLACK``), so rounding can only cause a needless scan. No entry with a gap of half a unit
or less outlives a move, hence ties always get a scan.

Cases: vectors that are null, of another length, or with null or non-finite components take
no part; rows without an id do, but become start centroids last; repeated rows each take
part; fewer vectors than k: as many clusters as vectors; an empty table gives no rows;
components are clamped to +-2**26 after scaling, so that squared distances fit in 64 bits;
an inertia beyond 64 bits is null; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise

#: Largest scaled component: 64 * (2 * 2**26)**2 stays below 2**63.
CLAMP = 1 << 26
#: Relative slack of bounds in doubles.
_SLACK = 1e-9
#: Vectors scanned at a time.
ROWS = 8192


def integer_vectors(table: DataFrame, dims: int, scale: int, key: str, vector: str) -> DataFrame:
    """id, v (array of int): floor(scale * x) of the vectors that take part."""
    v = F.col(vector).cast("array<double>")
    rows = table.select(F.col(key).cast("long").alias("id"), v.alias("v")).where("v is not null").where(F.size("v") == dims)
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    whole = lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(CLAMP))), F.lit(float(-CLAMP)))).cast("int")
    return rows.select("id", F.transform("v", whole).alias("v"))


def start_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``<seed>:<id>``, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select("v", digest.alias("h")).orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of x by rows of c) in 64-bit integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if most * most * x.shape[1] * 4 < 1 << 53:  # every sum is exact in doubles
        xd, cd = x.astype(np.float64), c.astype(np.float64)
        return ((xd * xd).sum(1)[:, None] - 2 * (xd @ cd.T) + (cd * cd).sum(1)).astype(np.int64)
    out = np.empty((len(x), len(c)), np.int64)
    for j, row in enumerate(c):
        d = x - row
        out[:, j] = (d * d).sum(1)
    return out


def _scan(vectors: DataFrame, centroids: np.ndarray, offsets: np.ndarray) -> DataFrame:
    """Entries (id, v, was, cluster, key) of ``vectors`` (id, v, cluster: so far, or -1)."""

    def scan(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                d = squared_distances(_matrix(b.column("v")), centroids)
                own = d.argmin(1)  # ties: the smaller number
                upper = np.sqrt(d[np.arange(len(d)), own].astype(np.float64))
                d[np.arange(len(d)), own] = np.iinfo(np.int64).max
                lower = np.sqrt(d.min(1).astype(np.float64)) if d.shape[1] > 1 else np.full(len(d), 1e18)
                off = offsets[own]
                gap = np.maximum(lower - upper - _SLACK * (lower + upper + off + 1), 0.5)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("v"), b.column("cluster"), pa.array(own.astype(np.int32)), pa.array(gap + off)],
                    names=["id", "v", "was", "cluster", "key"])

    return vectors.select("id", "v", "cluster").mapInArrow(scan, "id long, v array<int>, was int, cluster int, key double")


def _changes(entries: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts, sums) to add for the entries that changed their cluster: k rows a task, summed
    by component."""

    def add(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x, was, now = _matrix(b.column("v")), b.column("was").to_numpy(), b.column("cluster").to_numpy()
            for c in range(k):
                counts[c] += int((now == c).sum()) - int((was == c).sum())
                sums[c] += x[now == c].sum(0) - x[was == c].sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(counts), pa.array(list(sums))],
                                         names=["cluster", "n", "s"])

    part = entries.where("was != cluster").select("v", "was", "cluster").mapInArrow(add, "cluster int, n long, s array<long>")
    flat = part.select("cluster", F.posexplode(F.concat(F.array("n"), F.col("s"))).alias("i", "x"))
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for r in flat.groupBy("cluster", "i").agg(F.sum("x").alias("x")).collect():  # k * (dims + 1) rows
        if r["i"]:
            sums[r["cluster"], r["i"] - 1] = r["x"]
        else:
            counts[r["cluster"]] = r["x"]
    return counts, sums


def _beyond(offsets: np.ndarray) -> Column:
    """Entries that have not expired: one range of keys a cluster, which parquet can skip by."""
    out = F.lit(False)
    for c, off in enumerate(offsets.tolist()):
        out |= (F.col("cluster") == c) & (F.col("key") > off)
    return out


def _expired(last: np.ndarray, now: np.ndarray) -> Column:
    """Entries that the move from offsets ``last`` to ``now`` pops."""
    out = F.lit(False)
    for c, (a, b) in enumerate(zip(last.tolist(), now.tolist())):
        if b > a:
            out |= (F.col("cluster") == c) & (F.col("key") > a) & (F.col("key") <= b)
    return out


def drifted(offsets: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Offsets after the centroids moved: own drift plus the largest other one is added."""
    d = new - old
    drift = np.sqrt((d * d).sum(1).astype(np.float64)) * (1 + _SLACK)
    k = len(drift)
    other = np.array([np.delete(drift, c).max() if k > 1 else 0.0 for c in range(k)])
    return offsets + drift + other


class Clustering:
    """The centroids after the last round, and the heap tables whose live entries are the
    vectors with their cluster."""

    def __init__(self, vectors: DataFrame, k: int, rounds: int, seed: str):
        self.centroids = start_centroids(vectors, k, seed)
        self.tables: list[DataFrame] = []
        self.popped: list[DataFrame] = []
        k = len(self.centroids)
        self.offsets = np.zeros(k)
        if not k:
            return
        dims = self.centroids.shape[1]
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        self._push(_scan(vectors.withColumn("cluster", F.lit(-1)), self.centroids, self.offsets))
        for _ in range(rounds):
            n, s = _changes(self.tables[-1], k, dims)
            counts, sums = counts + n, sums + s
            full = counts > 0
            new = self.centroids.copy()
            new[full] = sums[full] // counts[full][:, None]  # floor
            last, self.offsets = self.offsets, drifted(self.offsets, self.centroids, new)
            self.centroids = new
            expired = _expired(last, self.offsets)
            popped = self.tables[0].where(expired)
            for t in self.tables[1:]:
                popped = popped.unionByName(t.where(expired))
            self._push(_scan(popped, new, self.offsets))

    def _push(self, entries: DataFrame) -> None:
        self.tables.append(materialise(entries.sortWithinPartitions("cluster", "key"), "heap"))

    def members(self) -> DataFrame:
        """id, v, cluster of every vector: the live entries of all tables."""
        live = _beyond(self.offsets)
        out = self.tables[0].where(live)
        for t in self.tables[1:]:
            out = out.unionByName(t.where(live))
        return out.select("id", "v", "cluster")


def cluster_vectors(table: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1",
                    key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per vector: vec_id, cluster, distance (squared, to the final centroid), cluster_inertia,
    inertia, centroid (array of int), centroid_sha256."""
    vectors = integer_vectors(table, dims, scale, key, vector)
    found = Clustering(vectors, k, rounds, seed)
    centroids = found.centroids
    if not len(centroids):
        return vectors.limit(0).select(F.col("id").alias("vec_id"), F.lit(0).alias("cluster"), *[
            F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.col("v").alias("centroid"),
            F.lit("").alias("centroid_sha256"))

    def measure(batches):
        for b in batches:
            if b.num_rows:
                d = _matrix(b.column("v")) - centroids[b.column("cluster").to_numpy()]
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("cluster"), pa.array((d * d).sum(1))],
                                                 names=["vec_id", "cluster", "distance"])

    rows = materialise(found.members().mapInArrow(measure, "vec_id long, cluster int, distance long"), "clusters")
    per = rows.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))  # at most k rows
    of = F.create_map(*[x for c, v in enumerate(centroids.tolist()) for x in (F.lit(c), F.struct(
        F.lit(v).alias("centroid"), F.lit(hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()).alias("sha")))])
    total = rows.agg(F.try_sum("distance").alias("x")).scalar()
    return rows.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", total.alias("inertia"),
        of[F.col("cluster")]["centroid"].alias("centroid"), of[F.col("cluster")]["sha"].alias("centroid_sha256"))
