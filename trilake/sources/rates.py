"""FX rates documents (S10): ``{base, date, rates: {code: rate}}`` -> rows
``currency, rate, base, date``. Parsing and the map explode are JVM-side
(``from_json`` + ``explode``), one output row per (document, currency)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATES_SCHEMA = T.StructType([
    T.StructField("base", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("rates", T.MapType(T.StringType(), T.DoubleType())),
])


def flatten_rates(docs: DataFrame, doc: str | None = None) -> DataFrame:
    """Explode parsed rates documents. ``doc`` names a struct column holding the
    document; by default the frame's own columns are ``base, date, rates``."""
    src = docs.select(F.col(f"{doc}.*")) if doc else docs
    return src.select(F.explode("rates").alias("currency", "rate"), "base", "date")


def read_rates_json(spark: SparkSession, path: str) -> DataFrame:
    """Read landed JSON documents with a fixed schema. A file holds one document (indented or
    not) or an array of them; text that is no document fails instead of giving no rows."""
    return flatten_rates(spark.read.schema(RATES_SCHEMA).option("multiLine", "true").option("mode", "FAILFAST").json(path))


def parse_rates(text: Column, base: Column | None = None, date: Column | None = None) -> Column:
    """A JSON text column holding a ``{code: rate}`` object -> rates document struct."""
    return F.struct(
        (base if base is not None else F.lit(None).cast("string")).alias("base"),
        (date if date is not None else F.lit(None).cast("string")).alias("date"),
        F.from_json(text, T.MapType(T.StringType(), T.DoubleType())).alias("rates"),
    )
