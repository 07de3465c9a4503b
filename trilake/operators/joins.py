"""Join shapes used by the lake.

Equi-joins are left to Catalyst/AQE: the planner broadcasts a side only when its
statistics are under ``spark.sql.autoBroadcastJoinThreshold`` (a size check Spark
does from the plan, and again at runtime from real shuffle sizes under AQE);
otherwise it shuffles both sides on the key (sort-merge), with AQE splitting skewed
partitions. One-row lookups (``limit(1)``, bounded by construction) are scalar
subqueries rather than joins, so no cartesian product is ever planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilake.session import known_bytes

#: Bytes of Parquet that a task of a join of large tables meets (some 30 times that in memory).
JOIN_TASK_BYTES = 12 << 20


def attach_scalar(df: DataFrame, scalar: DataFrame, cols: list[str] | None = None,
                  defaults: dict | None = None) -> DataFrame:
    """Add the columns of a (at most) one-row frame to every row.

    Each column is a scalar subquery over ``scalar.limit(1)``: Spark evaluates it
    once and ships the value to every task (the reference's broadcast one-row cross
    join, without a join node or a cartesian product). An empty scalar frame gives
    null, or ``defaults`` via coalesce. No driver-side branching on the row."""
    cols = cols or scalar.columns
    one = scalar.limit(1)
    exprs = {c: one.select(c).scalar() for c in cols}
    if defaults:
        exprs = {c: (F.coalesce(e, F.lit(defaults[c])) if c in defaults else e) for c, e in exprs.items()}
    return df.withColumns(exprs)


def cross_scalar(df: DataFrame, scalar: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """The SQL ``CROSS JOIN`` with a one-row CTE: every row gets the scalar's
    columns, and no scalar row -> empty result. Expressed as an EXISTS filter plus
    scalar subqueries, so no join (and no cartesian product) is planned."""
    one = scalar.limit(1)
    return attach_scalar(df.where(one.exists()), one, cols)


def keep_known(df: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Keep rows whose key exists in ``parents`` (distinct + inner in the
    reference; a left-semi join returns the same rows without the distinct shuffle
    and without duplicating children)."""
    pk = parent_key or key
    if pk == key:
        return df.join(parents.select(key), on=key, how="left_semi")
    return df.join(parents.select(F.col(pk).alias("__pk")), F.col(key) == F.col("__pk"), "left_semi")


def dealt_alike(key: str, *frames: DataFrame, task_bytes: int | None = None) -> list[DataFrame]:
    """Frames that will be joined on ``key`` and summed per key, dealt by it to so many tasks
    that each meets about ``task_bytes`` of their files: what a task sorts and hashes does not
    grow with the tables. Small frames stay as they are."""
    spark = frames[0].sparkSession
    tasks = -(-sum(known_bytes(f) for f in frames) // (task_bytes or JOIN_TASK_BYTES))
    if tasks <= spark.sparkContext.defaultParallelism:
        return list(frames)
    return [f.repartition(tasks, key) for f in frames]


def distinct_keys(df: DataFrame, *cols: str) -> DataFrame:
    """The distinct values of a projection (the reference's ``select().distinct()``
    of title ids). Planned as a partial + final HashAggregate, so duplicates collapse
    map-side before the shuffle."""
    return df.select(*cols).distinct()
