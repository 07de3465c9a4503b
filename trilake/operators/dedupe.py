"""One row per key, the greatest by the given order.

Planned as a per-key limit in every task before the shuffle (WindowGroupLimit), so a
key that holds a third of all rows sends one row per task, never its whole group. That
limit sorts a task's rows once and the reducer sorts what is left: cheap where keys
repeat, an extra sort where they hardly do. ``partial=False`` leaves the first sort out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _descending(df: DataFrame, names) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names if n in df.columns]


def best_per_key(df: DataFrame, key: str | list[str], *order: str, ties: str | list[str] | None = None,
                 partial: bool = True) -> DataFrame:
    """The row of each key that is greatest by ``order`` (nulls last), then by ``ties``.
    ``ties="*"`` stands for all other columns in name order: the winner then depends on the
    rows alone, not on how they came in. Names that the frame lacks are skipped."""
    keys = [key] if isinstance(key, str) else list(key)
    if ties == "*":
        ties = sorted(set(df.columns) - set(keys) - set(order))
    by = _descending(df, [*order, *([ties] if isinstance(ties, str) else ties or [])]) or [F.lit(0)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    # compared through a cast, the limit is not pushed below the shuffle
    first = F.col("_place") == 1 if partial else F.col("_place").cast("string") == "1"
    return df.withColumn("_place", place).where(first).drop("_place")
