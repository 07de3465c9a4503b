"""Guarded statistics.

Spark 4 runs with ANSI on: ``corr`` over a constant column raises DIVIDE_BY_ZERO
even inside ``when``. The Pearson coefficient is rebuilt from population moments
over pair-complete rows and divided with ``try_divide`` so constants, single rows
and all-null sides give null instead of an error. Everything stays a built-in
declarative aggregate (partial + final HashAggregate, no Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation of x and y over rows where both are non-null; null when
    undefined (fewer than two distinct values on a side)."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    both = x.isNotNull() & y.isNotNull()
    xs = F.when(both, x.cast("double"))
    ys = F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def weighted_mean(x: Column | str, w: Column | str) -> Column:
    """``sum(x*w) / sum(w)``; a null x drops from the numerator only."""
    x = F.col(x) if isinstance(x, str) else x
    w = F.col(w) if isinstance(w, str) else w
    return F.try_divide(F.sum(x * w), F.nullif(F.sum(w), F.lit(0)))
