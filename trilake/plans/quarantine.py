"""Refused rows with their reasons (F1-F3, P2, P3), out of the same pass as the clean ones.

The cleaning rules refuse raw rows without a usable key or rate. Here every raw row gets the
first reason against it, or none; typed rows and refused rows are written by one pass over
the raw files, into two folders of one staging table. W1 then reads the typed rows (no
second CSV parse, and a lineage cut before its shuffle), the refused ones keep their raw
text as JSON with the reason. A row is refused if and only if the row-level cleaner
(``plans.trusted``) drops it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilake.functions.clean import identifier, known_text, real
from trilake.plans import trusted as T
from trilake.session import shared_dir

TYPED = {"movies": T.movie_typed, "tv_shows": T.tv_typed, "people": T.people_typed, "movie_reviews": T.review_typed, "exchange": T.rate_typed}
_OWN = ("_reason", "_record")


def _id_reasons(key: str) -> list[tuple[str, Column]]:
    text, number = known_text(F.col(key)), identifier(F.col(key))
    return [(f"{key} is missing", text.isNull()), (f"{key} is no number", number.isNull()), (f"{key} is not positive", number <= 0)]


def _reasons(table: str) -> list[tuple[str, Column]]:
    if table == "movie_reviews":
        return [("review_id is missing", known_text(F.col("review_id")).isNull())]
    if table == "exchange":
        rate = real(F.col("rate"))
        return [("currency is missing", known_text(F.col("currency")).isNull()), ("rate is missing", known_text(F.col("rate")).isNull()),
                ("rate is no number", rate.isNull()), ("rate is not positive", rate <= 0)]
    return _id_reasons("tmdb_id")


def reason(table: str) -> Column:
    """The first reason against a raw row of a lake table, or null."""
    return F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(text)) for text, test in _reasons(table)])


def judged(raw: DataFrame, table: str) -> DataFrame:
    """Raw rows typed, all of them, with ``_reason`` and, where there is one, ``_record`` (the raw
    columns as JSON, nulls included)."""
    record = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in raw.columns]), {"ignoreNullFields": "false"})
    why = reason(table)
    return TYPED[table](raw.withColumns({"_reason": why, "_record": F.when(why.isNotNull(), record)}))


def rejected_rows(raw: DataFrame, table: str) -> DataFrame:
    """table_name, reason, record of the refused rows, without staging."""
    return _shown(judged(raw, table).where("_reason IS NOT NULL"), table)


def _shown(rows: DataFrame, table: str) -> DataFrame:
    return rows.select(F.lit(table).alias("table_name"), F.col("_reason").alias("reason"), F.col("_record").alias("record"))


def stage(spark: SparkSession, raw: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """(the typed rows that stay, by table; the refused rows of all tables)."""
    root = shared_dir(spark, "staging", uuid.uuid4().hex)
    rows, refused = {}, None
    for name, df in raw.items():
        both = judged(df, name).withColumn("_refused", F.col("_reason").isNotNull())
        both.write.partitionBy("_refused").parquet(f"{root}/{name}")
        staged = spark.read.schema(both.schema).parquet(f"{root}/{name}")
        rows[name] = staged.where(~F.col("_refused")).drop("_refused", *_OWN)
        part = _shown(staged.where("_refused"), name)
        refused = part if refused is None else refused.unionByName(part)
    return rows, refused
