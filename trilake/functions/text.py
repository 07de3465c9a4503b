"""Display text built with Spark string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder shown for missing numbers, and the money suffixes with
# their divisors used by the KPI cards (billions of USD, trillions of COP).
MISSING_TEXT = "n/d"
MONEY_SCALES = {"B": 1e9, "T": 1e12, "M": 1e6}


def money_text(x: Column | str, suffix: str = "B", divisor: float | None = None) -> Column:
    """``$1,234.56B``; ``n/d`` when null."""
    x = F.col(x) if isinstance(x, str) else x
    div = divisor if divisor is not None else MONEY_SCALES[suffix]
    txt = F.concat(F.lit("$"), F.format_number(x.cast("double") / F.lit(div), 2), F.lit(suffix))
    return F.coalesce(txt, F.lit(MISSING_TEXT))


def coef_text(x: Column | str) -> Column:
    """Signed three-decimal coefficient (``+0.123``); ``n/d`` on null or NaN."""
    x = F.col(x) if isinstance(x, str) else x
    d = x.cast("double")
    return F.when(d.isNull() | F.isnan(d), F.lit(MISSING_TEXT)).otherwise(F.format_string("%+.3f", d))


def percent_text(x: Column | str, digits: int = 1) -> Column:
    """``12,345.6%``."""
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(F.concat(F.format_number(x.cast("double"), digits), F.lit("%")), F.lit(MISSING_TEXT))


def count_text(x: Column | str) -> Column:
    """Integer with thousands separators."""
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(F.format_number(x.cast("double"), 0), F.lit(MISSING_TEXT))
