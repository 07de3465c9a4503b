"""Dashboard data work (K1-K3) as Spark plans over curated tables.

The reference computes these with pandas after reading whole curated tables into
one process; here they are aggregates / top-k plans, and only the final small
result (one KPI row, <= 25 display rows) is ever collected by a caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilake.functions.stats import weighted_mean
from trilake.functions.text import coef_text, count_text, money_text, percent_text
from trilake.operators.sample import top_then_resort

# Display scales and the column captions of the dashboard tables.
USD_BILLIONS = 1e9
COP_TRILLIONS = 1e12
USD_MILLIONS = 1e6
GENRE_CAPTIONS = {"genre": "Género", "n_movies": "# películas",
                  "revenue_usd_total": "Revenue total (USD)", "revenue_usd_avg": "Revenue promedio (USD)",
                  "revenue_cop_total": "Revenue total (COP)", "revenue_cop_avg": "Revenue promedio (COP)"}
ACTOR_CAPTIONS = {"actor_id": "ID", "actor_name": "Actor", "n_movies_rentables": "# películas rentables",
                  "avg_profit_usd": "Profit promedio (USD)", "total_revenue_usd": "Revenue total (USD)"}
YEAR_CAPTIONS = {"release_year": "Año", "n_movies": "# películas", "revenue_usd_total": "Revenue (USD)",
                 "revenue_cop_total": "Revenue (COP)", "avg_roi_pct": "ROI promedio (%)"}
DIRECTOR_CAPTIONS = {"director_name": "Director", "n_movies": "# películas",
                     "avg_roi_pct": "ROI promedio (%)", "avg_profit_usd": "Profit promedio (USD)",
                     "total_revenue_usd": "Revenue total (USD)"}


def global_kpis(revenue_by_year: DataFrame) -> DataFrame:
    """K1 (A10, A11): one row with title count, revenue totals and the ROI mean
    weighted by titles per year (B10: years without ROI still weigh in)."""
    return revenue_by_year.agg(
        F.sum("n_movies").alias("n_movies"),
        F.sum("revenue_usd_total").alias("revenue_usd"),
        F.sum("revenue_cop_total").alias("revenue_cop"),
        weighted_mean("avg_roi_pct", "n_movies").alias("roi_pct"),
    )


def kpi_text(kpis: DataFrame, keep: bool = False) -> DataFrame:
    """K2: KPI cards as text (``keep`` also keeps the numeric KPI columns)."""
    return kpis.select(*(kpis.columns if keep else []),
        count_text("n_movies").alias("n_movies_text"),
        money_text("revenue_usd", "B", USD_BILLIONS).alias("revenue_usd_text"),
        money_text("revenue_cop", "T", COP_TRILLIONS).alias("revenue_cop_text"),
        percent_text("roi_pct", 1).alias("roi_pct_text"),
    )


def correlation_text(corr: DataFrame) -> DataFrame:
    """K2: coefficient cards (``+0.123`` / ``n/d``)."""
    return corr.select(*[coef_text(c).alias(f"{c}_text") for c in corr.columns])


def genre_feed(revenue_by_genre: DataFrame, k: int = 15) -> DataFrame:
    """K3: top ``k`` genres by revenue, ascending for a horizontal bar chart, with
    revenue in billions and captioned columns."""
    top = top_then_resort(revenue_by_genre, k, "revenue_usd_total", key="genre")
    return (top.withColumn("revenue_usd_billions", F.col("revenue_usd_total").cast("double") / USD_BILLIONS)
               .withColumnsRenamed(GENRE_CAPTIONS))


def actor_feed(top_actors: DataFrame) -> DataFrame:
    return (top_actors.orderBy(F.desc("n_movies_rentables"), F.asc("actor_id"))
            .withColumnsRenamed(ACTOR_CAPTIONS))


def actor_table(top_actors: DataFrame) -> DataFrame:
    """K3: the three columns that the page lists under the chart."""
    return (top_actors.orderBy(F.desc("n_movies_rentables"), F.asc("actor_id"))
            .select("actor_name", "n_movies_rentables", "avg_profit_usd").withColumnsRenamed(ACTOR_CAPTIONS))


def chart_order(feed: DataFrame, measure: str, label: str) -> DataFrame:
    """K3: rows of a horizontal bar chart, smallest bar first (charts draw upwards)."""
    return feed.orderBy(F.col(measure).asc(), F.col(label).desc())


def genre_table(revenue_by_genre: DataFrame) -> DataFrame:
    """K3: all genres by revenue, largest first, with captions."""
    return (revenue_by_genre.orderBy(F.desc("revenue_usd_total"), F.asc("genre")).withColumnsRenamed(GENRE_CAPTIONS))


def bar_labels(feed: DataFrame, label: str, measure: str, text) -> DataFrame:
    """K3: (label, measure, bar_label): the text printed at each bar's end."""
    return feed.select(label, measure, text.alias("bar_label"))


def genre_bars(revenue_by_genre: DataFrame, k: int = 15) -> DataFrame:
    top = top_then_resort(revenue_by_genre, k, "revenue_usd_total", key="genre")
    return bar_labels(top, "genre", "revenue_usd_total", money_text("revenue_usd_total", "B", USD_BILLIONS))


def director_bars(roi_by_director: DataFrame) -> DataFrame:
    return bar_labels(chart_order(roi_by_director, "avg_roi_pct", "director_name"), "director_name", "avg_roi_pct",
                      percent_text("avg_roi_pct", 1))


def year_feed(revenue_by_year: DataFrame) -> DataFrame:
    return (revenue_by_year.orderBy("release_year")
            .withColumn("revenue_usd_billions", F.col("revenue_usd_total").cast("double") / USD_BILLIONS)
            .withColumn("revenue_cop_trillions", F.col("revenue_cop_total").cast("double") / COP_TRILLIONS)
            .withColumnsRenamed(YEAR_CAPTIONS))


def director_feed(roi_by_director: DataFrame) -> DataFrame:
    return (roi_by_director.orderBy(F.desc("avg_roi_pct"), F.asc("director_name"))
            .withColumnsRenamed(DIRECTOR_CAPTIONS))


def scatter_feed(sample: DataFrame) -> DataFrame:
    return sample.withColumn("revenue_usd_millions", F.col("revenue_usd").cast("double") / USD_MILLIONS)


def axis_max(df: DataFrame, measure: str, pad: float = 1.15, scale: float = 1.0,
             chart: str | None = None) -> DataFrame:
    """Padded maximum of a measure (chart axis range), one row
    ``(chart, axis_max)``."""
    return df.agg(F.lit(chart or measure).alias("chart"),
                  (F.max(F.col(measure).cast("double")) / F.lit(scale) * F.lit(pad)).alias("axis_max"))


def dashboard_feeds(spark, curated_prefix: str, cache: bool = True) -> dict[str, DataFrame]:
    """All dashboard data work (K1-K3, A12) as plans over the curated zone."""
    from trilake.sources.parquet import load_curated
    c = {n: load_curated(spark, curated_prefix, n, cache) for n in
         ("revenue_by_genre", "top_actors_rentables", "revenue_by_year", "roi_by_director",
          "ratings_correlations", "ratings_vs_revenue_sample")}
    kpis = global_kpis(c["revenue_by_year"])
    return {
        "kpis": kpis,
        "kpi_text": kpi_text(kpis),
        "correlation_text": correlation_text(c["ratings_correlations"]),
        "genres": genre_feed(c["revenue_by_genre"]),
        "actors": actor_feed(c["top_actors_rentables"]),
        "actor_table": actor_table(c["top_actors_rentables"]),
        "actor_chart": chart_order(c["top_actors_rentables"], "n_movies_rentables", "actor_name"),
        "director_chart": chart_order(c["roi_by_director"], "avg_roi_pct", "director_name"),
        "genre_table": genre_table(c["revenue_by_genre"]),
        "genre_bars": genre_bars(c["revenue_by_genre"]),
        "director_bars": director_bars(c["roi_by_director"]),
        "years": year_feed(c["revenue_by_year"]),
        "directors": director_feed(c["roi_by_director"]),
        "scatter": scatter_feed(c["ratings_vs_revenue_sample"]),
        "axis_ranges": axis_max(c["revenue_by_genre"], "revenue_usd_total", 1.15, USD_BILLIONS, "genres")
            .unionByName(axis_max(c["top_actors_rentables"], "n_movies_rentables", 1.12, chart="actors"))
            .unionByName(axis_max(c["roi_by_director"], "avg_roi_pct", 1.15, chart="directors")),
    }
