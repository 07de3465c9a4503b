"""K1-K3 and the display text helpers."""

import math

from pyspark.sql import functions as F

from trilake.functions.text import coef_text, count_text, money_text, percent_text
from trilake.plans import kpi
from trilake.session import size_shuffle, size_shuffle_for


def test_money_and_count_text(spark):
    df = spark.createDataFrame([(1234567890.0,), (None,)], "x double")
    out = [r[0] for r in df.select(money_text("x", "B")).collect()]
    assert out == ["$1.23B", "n/d"]
    out = [r[0] for r in df.select(count_text("x")).collect()]
    assert out == ["1,234,567,890", "n/d"]
    assert df.select(percent_text(F.lit(12345.67))).first()[0] == "12,345.7%"


def test_coef_text_signs_and_missing(spark):
    df = spark.createDataFrame([(0.12345,), (-0.5,), (None,), (float("nan"),)], "x double")
    assert [r[0] for r in df.select(coef_text("x")).collect()] == ["+0.123", "-0.500", "n/d", "n/d"]


def test_global_kpis_weighted_roi(spark):
    years = spark.createDataFrame(
        [(1990, 10, 100.0, 400000.0, 50.0), (1991, 30, 300.0, 1200000.0, 150.0), (1992, 10, 10.0, 40.0, None)],
        "release_year int, n_movies long, revenue_usd_total double, revenue_cop_total double, avg_roi_pct double")
    k = kpi.global_kpis(years).first()
    assert k["n_movies"] == 50 and k["revenue_usd"] == 410.0
    # The year without ROI still weighs in the denominator
    assert math.isclose(k["roi_pct"], (50.0 * 10 + 150.0 * 30) / 50)
    t = kpi.kpi_text(kpi.global_kpis(years)).first()
    assert t["n_movies_text"] == "50" and t["roi_pct_text"] == "100.0%"


def test_genre_feed_top_then_ascending(spark):
    g = spark.createDataFrame([(f"g{i}", i, float(i)) for i in range(20)],
                              "genre string, n_movies long, revenue_usd_total double")
    for c in ("revenue_usd_avg", "revenue_cop_total", "revenue_cop_avg"):
        g = g.withColumn(c, F.lit(1.0))
    out = [r["Género"] for r in kpi.genre_feed(g).collect()]
    assert out == [f"g{i}" for i in range(5, 20)]           # top 15, re-sorted ascending


def test_size_shuffle(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffle(spark, 1 << 20) == spark.sparkContext.defaultParallelism
        assert size_shuffle(spark, 100 << 40) == 409_600         # 100 TiB of shuffle: no cap
        assert size_shuffle(spark, 1 << 40) == 4096               # 1 TiB / 256 MiB
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert size_shuffle_for(spark, spark.range(10)) == 8     # small inputs leave it alone
        assert size_shuffle_for(spark, spark.range(10_000), target_bytes=1000) >= 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
