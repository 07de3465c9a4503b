"""Small corpora for the operator tests: every edge case a table can bring."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def frame(spark: SparkSession, rows: list, extra: bool = False) -> DataFrame:
    """documents with these (doc_id, text); ``extra`` adds columns with clashing names."""
    df = spark.createDataFrame([(i, t, "en", "src0", len(t) if t else 0) for i, t in rows], SCHEMA)
    if extra:
        for name in ("size", "h", "n", "words", "piece", "length", "score", "fp", "host", "label", "_i", "_th", "_own_th", "_own_id", "_starts", "id", "least"):
            df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def table(df: DataFrame, *columns: str) -> list[tuple]:
    columns = columns or tuple(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))
