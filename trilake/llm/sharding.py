"""Sharding: contiguous, byte-balanced shards from global prefix sums.

Rows are range-partitioned by ``doc_id`` (ties spread), every partition sums its own
sizes, a window over those per-partition totals (one row a partition) gives each
partition's global offset, and a row whose middle byte lies in the k-th n-th of all
bytes goes to shard k. So shards are contiguous in doc_id order, and a shard differs from
the equal target by less than one document at each end.

Cases: null text has no bytes (size 1, crc 0); null doc_ids come first; repeated rows are
rows like any other; an empty table gives no rows; other columns are ignored by
``shard_plan`` and kept by ``shard``. Equal texts are not held together: the law is
``bytes``, and a group of copies may exceed a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import range_sorted


def sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(t) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(t, "utf-8")).alias("text_crc32"))


def shard_plan(docs: DataFrame, n_shards: int = 16, text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (its place in the shard)."""
    rows = range_sorted(sizes(docs, text), [F.col("doc_id"), F.col("text_crc32"), F.col("size")],
                        "shard-rows", running="size")
    # one row for each partition: bounded by the number of partitions, not by the rows
    totals = rows.groupBy("_pid").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_b0"),
                            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_r0"),
                            F.sum("_bytes").over(Window.partitionBy()).alias("_all"))
    placed = rows.join(F.broadcast(offsets), "_pid").select(
        "doc_id", "size", "text_crc32", (F.col("_r0") + F.col("_i")).alias("_row"),
        F.least(F.lit(n_shards - 1), F.expr(
            f"((2 * (_b0 + _before) + size) * {int(n_shards)}) div (2 * _all)")).cast("int").alias("shard"))
    first = placed.groupBy("shard").agg(F.min("_row").alias("_first"))  # n_shards rows
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot"))
