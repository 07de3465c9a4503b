"""Financial metrics and currency conversion.

Types are preserved: decimal money times a decimal rate stays exact decimal, doubles
stay doubles, so the same code serves the reference's double tables and exact
decimal inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


DERIVED = ("profit_usd", "roi_pct")


def add_profit_roi(df: DataFrame, revenue: str = "revenue_usd", budget: str = "budget_usd",
                   profit: str = "profit_usd", roi: str = "roi_pct") -> DataFrame:
    """Drop stale derived columns, then
    ``profit = revenue - budget`` (both known) and
    ``roi = revenue / budget * 100`` when budget > 0 (gross ratio; break-even = 100)."""
    r, b = F.col(revenue), F.col(budget)
    df = df.drop(profit, roi)
    return df.withColumns({
        profit: F.when(r.isNotNull() & b.isNotNull(), r - b),
        roi: F.when(b.isNotNull() & (b > 0), (r.cast("double") / b.cast("double")) * 100),
    })


def rate_for(exchange: DataFrame, code: str = "COP", currency: str = "currency",
             rate: str = "rate", out: str = "_rate") -> DataFrame:
    """The (at most one) rate row of ``code`` from a cleaned exchange table."""
    return exchange.where(F.col(currency) == code).select(F.col(rate).alias(out)).limit(1)


def convert_currency(df: DataFrame, exchange: DataFrame, code: str = "COP",
                     src: str = "revenue_usd", out: str = "revenue_cop",
                     on_missing: str = "identity") -> DataFrame:
    """``out = src * rate(code)``.

    The one-row rate is a scalar subquery: Spark computes it once (at most one row,
    ``limit(1)``) and ships the value to every task, like the reference's broadcast
    one-row cross join, but without a join node, so a query that never reads ``out``
    prunes the rate lookup entirely. ``on_missing="identity"`` keeps the reference
    behaviour (no rate -> factor 1, B2); ``"null"`` gives null instead. Decided inside
    the plan, no driver-side ``take(1)`` branch.
    """
    if on_missing not in ("identity", "null"):
        raise ValueError("on_missing must be 'identity' or 'null'")
    rate = rate_for(exchange, code).scalar()
    # lit(1) (not 1.0) so a decimal rate keeps the product exact decimal.
    factor = rate if on_missing == "null" else F.coalesce(rate, F.lit(1))
    return df.withColumn(out, F.col(src) * factor)


def roi_local(revenue: str = "revenue_usd", budget: str = "budget_usd", rate: str = "cop_rate"):
    """ROI in local currency, net of cost:
    ``(rev*r - bud*r) / (bud*r) * 100`` when budget > 0. Equals ``roi_pct - 100``."""
    r, b, k = F.col(revenue), F.col(budget), F.col(rate)
    return F.when(b.isNotNull() & (b > 0),
                  F.try_divide((r * k).cast("double") - (b * k).cast("double"), (b * k).cast("double")) * 100)


def financial_metrics(movies: DataFrame, exchange: DataFrame, code: str = "COP",
                      on_missing: str = "identity") -> DataFrame:
    """Profit, ROI and converted revenue for the title table."""
    return convert_currency(add_profit_roi(movies), exchange, code, on_missing=on_missing)
