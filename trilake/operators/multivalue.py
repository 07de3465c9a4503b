"""Comma-list columns (M1-M4): tokens as rows.

``inline`` is a per-row Generate inside the scan's stage, no shuffle; a null or blank
list gives no rows. ``first`` marks the first occurrence of a token in its row's list:
where the key is unique, counting these counts distinct keys per token without a
shuffle on (token, key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilake.functions.clean import identifier


def _rows(df: DataFrame, tokens: Column, out: str, keep: list[str] | None, first: str | None) -> DataFrame:
    pairs = F.transform(tokens, lambda x, i: F.struct(x.alias(out), (F.array_position(tokens, x) == i + 1).alias(first or "_first")))
    rows = df.select(*(df.columns if keep is None else keep), F.inline(pairs))
    return rows if first else rows.drop("_first")


def token_rows(df: DataFrame, col: str, out: str, keep: list[str] | None = None, first: str | None = None,
               sep: str = ",") -> DataFrame:
    """M1+M2: one row per trimmed, non-blank token of ``col``; ``keep`` names the carried
    columns (default: all); ``sep`` is a regex, as for ``split``."""
    tokens = F.filter(F.transform(F.split(F.col(col), sep), lambda x: F.trim(x)), lambda x: x != "")
    return _rows(df, tokens, out, keep, first)


def bridge(df: DataFrame, key: str, col: str, out: str, distinct: bool = False) -> DataFrame:
    """(key, token) rows; a token that a list repeats stays repeated unless
    ``distinct`` (no shuffle: only the first occurrence in a row's list is kept)."""
    if not distinct:
        return token_rows(df, col, out, keep=[key])
    return token_rows(df, col, out, keep=[key], first="_once").where("_once").drop("_once")


def id_rows(df: DataFrame, col: str, out: str, keep: list[str] | None = None, first: str | None = None) -> DataFrame:
    """M4: one row per id of a comma list; tokens that are no number are dropped."""
    ids = F.filter(F.transform(F.split(F.col(col), ","), identifier), lambda x: x.isNotNull())
    return _rows(df, ids, out, keep, first)
