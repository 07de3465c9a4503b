"""Register zone tables as session temp views for the SQL questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The five tables the SQL notebook registers (tv_shows is not one).
SQL_TABLES = ("movies", "movie_genres", "people", "movie_reviews", "exchange")


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> dict[str, str]:
    """Register each frame as ``<prefix><name>``; returns name -> view name."""
    out = {}
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        out[name] = view
    return out


def register_trusted(spark: SparkSession, trusted_prefix: str, prefix: str = "") -> dict[str, str]:
    from trilake.sources.parquet import read_tables
    return register_views(read_tables(spark, trusted_prefix, SQL_TABLES), prefix)
