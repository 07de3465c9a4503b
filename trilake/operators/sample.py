"""Sampling and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Groups that the tasks' rows are merged in before the last step.
MERGE_GROUPS = 32


def _smallest(df: DataFrame, n: int, by: list[Column], groups: int = MERGE_GROUPS) -> DataFrame:
    """The n rows smallest by ``by`` in one scan: every task keeps its own n (its threshold
    tightens as better rows come), the tasks' rows meet in ``groups`` groups that keep n each,
    and only those reach the last step. The number of tasks does not reach it."""
    dealt = df.withColumn("__g", F.pmod(F.spark_partition_id(), F.lit(groups)))
    place = F.row_number().over(Window.partitionBy("__g").orderBy(*by))
    few = dealt.withColumn("__i", place).where(F.col("__i") <= n).drop("__g", "__i")
    return few.orderBy(*by).limit(n)


def sample_n(df: DataFrame, n: int, seed: int = 42, total: int | None = None) -> DataFrame:
    """A random sample of n rows (all, if there are fewer), as the reference draws it: each
    row is as likely as any other. Rows get random priorities in the one scan of the input and
    the n smallest stay, so nothing is counted first. The rows depend on the partitioning; use
    ``hash_sample`` for a stable answer. With a known ``total``, rows that cannot be among the
    n (but for a chance below 1e-9) are dropped before anything is kept."""
    drawn = df.withColumn("__r", F.rand(seed))
    if total is not None and total > 0:
        most = (n + 7 * n ** 0.5 + 40) / total
        drawn = drawn.where(F.col("__r") < most) if most < 1 else drawn
    return _smallest(drawn, n, [F.col("__r")]).drop("__r")


def hash_key(key: str | list[str], seed: int = 42) -> Column:
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_sample(df: DataFrame, n: int, key: str | list[str], seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest ``md5(seed:key)``. Deterministic across
    partitionings and engines.

    The hashes are counted by their leading zero bits first (at most 61 counts a task). The
    smallest octave below which there are n rows is the threshold: at least n rows pass it for
    certain, about 2n in all, however many tasks read the input. Only those are sorted."""
    keys = [key] if isinstance(key, str) else list(key)
    hashed = df.withColumn("__h", hash_key(keys, seed)).withColumn("__b", _octave(F.col("__h")))
    counts = hashed.groupBy("__b").agg(F.count(F.lit(1)).alias("c"))
    upto = counts.withColumn("upto", F.sum("c").over(Window.orderBy("__b")))  # at most 61 rows
    threshold = upto.agg(F.coalesce(F.min(F.when(F.col("upto") >= n, F.col("__b"))), F.lit(60))).scalar()
    return (hashed.where(F.col("__b") <= threshold).orderBy(F.col("__h"), *[F.col(k) for k in keys])
            .limit(n).drop("__h", "__b"))


def _octave(md5: Column) -> Column:
    """Binary digits of the first 60 bits of a hash, 0 to 60: uniform hashes have k with
    probability 2**(k-61), and smaller hashes never have more."""
    return F.length(F.ltrim(F.conv(F.substring(md5, 1, 15), 16, 2), F.lit("0")))


def top_then_resort(df: DataFrame, k: int, measure: str, *, key: str | None = None) -> DataFrame:
    """Top ``k`` by ``measure`` descending, re-sorted ascending for display."""
    order = [F.col(measure).desc_nulls_last()] + ([F.col(key).asc()] if key else [])
    return df.orderBy(*order).limit(k).orderBy(F.col(measure).asc_nulls_first(), *([F.col(key).desc()] if key else []))
