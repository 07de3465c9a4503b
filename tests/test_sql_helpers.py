"""SQL-text helpers agree with their DataFrame twins."""

from pyspark.sql import functions as F

from trilake.functions.clean import identifier
from trilake.functions.stats import safe_corr
from trilake.plans.questions_sql import corr_sql, id_sql


def test_id_sql_equals_identifier(spark):
    vals = ["1995", "1995.0", "12.7", ".5", "5.", " 7 ", "1e3", "99999999999", "abc", "", "+4", "-3.9", None,
            "\t12.7\t", "\n5\n"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = df.select(identifier(F.col("s")).alias("a"), F.expr(id_sql("s")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)


def test_corr_guards(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, 2.0), (3.0, 5.0, None), (None, 5.0, 4.0)],
                               "x double, c double, y double")
    r = df.agg(safe_corr("x", "c").alias("const"), safe_corr("x", "y").alias("pair"),
               F.expr(corr_sql("x", "y")).alias("pair_sql"), F.corr("x", "y").alias("builtin")).first()
    assert r["const"] is None                      # constant side: null, no DIVIDE_BY_ZERO
    assert abs(r["pair"] - 1.0) < 1e-12 and abs(r["pair_sql"] - r["builtin"]) < 1e-12
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double").agg(safe_corr("x", "y")).first()[0]
    assert one is None
