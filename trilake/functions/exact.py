"""Sums of doubles that do not depend on the order of the rows.

Adding doubles rounds at every step, so a plain ``sum`` differs in its last digits with the
partitioning. Here a double is cut into four whole numbers (limbs) of 24 bits each,

    x = l0 * 2**24 + l1 + l2 * 2**-24 + l3 * 2**-48 (+ what is below 2**-48, dropped),

each cut is exact, and limbs are added as 64-bit integers. The sums are the same for any
order, and they can be taken back: a row that goes subtracts what it has added, which is
what maintained answers (``plans.delta``) live on. Up to 2**39 rows a group.

Infinite and not-a-number values, and magnitudes from 2**60, have no limbs; a group that holds
one gets the plain sum. Decimals and integers are exact anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

LIMBS = 4
_STEP = float(1 << 24)
_LIMIT = float(1 << 60)


def tame(x: Column) -> Column:
    """Whether a double has limbs (false for null too)."""
    return F.coalesce(F.abs(x) < _LIMIT, F.lit(False)) & ~F.isnan(x)


def limbs(x: Column) -> list[Column]:
    """The four limbs of a double; null where it has none."""
    rest = F.when(tame(x), x) / _STEP
    out = []
    for _ in range(LIMBS):
        whole = rest.cast("bigint")  # cut towards zero: what is left is exact
        out.append(whole)
        rest = (rest - whole) * _STEP
    return out


def join_limbs(sums: list[Column]) -> Column:
    """The double that summed limbs stand for, rounded in one fixed order."""
    total = sums[-1].cast("double")
    for s in reversed(sums[:-1]):
        total = total / _STEP + s
    return total * _STEP


def _exact(df: DataFrame, name: str) -> bool:
    kind = df.schema[name].dataType
    return isinstance(kind, (DecimalType, IntegralType))


def _wild(x: Column) -> Column:
    """Aggregate: whether a group holds a value without limbs."""
    return F.max(x.isNotNull() & ~tame(x))


def exact_sum(x: Column) -> Column:
    """Aggregate: the sum of doubles, the same for any order of the rows."""
    x = x.cast("double")
    return F.when(_wild(x), F.sum(x)).otherwise(join_limbs([F.sum(c) for c in limbs(x)]))


def exact_mean(x: Column) -> Column:
    """Aggregate: the mean of doubles, the same for any order of the rows."""
    x = x.cast("double")
    return F.when(_wild(x), F.avg(x)).otherwise(join_limbs([F.sum(c) for c in limbs(x)]) / F.nullif(F.count(x), F.lit(0)))


def total(df: DataFrame, name: str) -> Column:
    """Aggregate: the sum of a column, order-independent whatever its type."""
    return F.sum(name) if _exact(df, name) else exact_sum(F.col(name))


def mean(df: DataFrame, name: str) -> Column:
    """Aggregate: exact sum / count, divided once in doubles."""
    if _exact(df, name):
        return F.sum(name).cast("double") / F.nullif(F.count(name), F.lit(0))
    return exact_mean(F.col(name))
