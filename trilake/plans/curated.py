"""Trusted -> curated job (D7) and the SQL questions over trusted views (S11 + Q1-Q5).

Each curated table is executed ONCE: the write carries an ``Observation`` for the
row count and previews are optional (the reference ran show + count + write).
``movies`` is scanned from Parquet by every question; Catalyst prunes each scan to
the question's columns and pushes its filters into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trilake.operators.joins import dealt_alike
from trilake.plans import questions as Q
from trilake.plans import questions_sql as QS
from trilake.session import size_shuffle_for
from trilake.sources.parquet import read_tables, show_top
from trilake.sources.versions import Zone
from trilake.sources.views import register_trusted, register_views

CURATED = ("revenue_by_genre", "top_actors_rentables", "revenue_by_year", "roi_by_director",
           "ratings_correlations", "ratings_vs_revenue_sample")


def curated_tables(trusted: dict[str, DataFrame], sample_size: int = Q.SAMPLE_SIZE,
                   decade_from: int = Q.DECADE_FROM, min_dir_movies: int = Q.MIN_DIR_MOVIES,
                   sample_mode: str = "bernoulli", use_bridge: bool = False) -> dict[str, DataFrame]:
    """D1-D6 as lazy plans. ``use_bridge=False`` (default) answers D1 by exploding
    ``movies.genres`` in the movies scan, which gives the same rows as joining the
    trusted bridge (T7 derives the bridge from that column in the same job) without
    a shuffle join of two large tables; ``True`` joins the bridge like the reference."""
    movies, reviews = trusted["movies"], trusted["movie_reviews"]
    return {
        "revenue_by_genre": Q.revenue_by_genre(movies, trusted.get("movie_genres") if use_bridge else None),
        "top_actors_rentables": Q.top_actors_rentables(movies, trusted["people"]),
        "revenue_by_year": Q.revenue_by_year(movies, decade_from),
        "roi_by_director": Q.roi_by_director(movies, min_dir_movies),
        "ratings_correlations": Q.ratings_correlations(movies, reviews),
        "ratings_vs_revenue_sample": Q.ratings_vs_revenue_sample(movies, reviews, sample_size,
                                                                  mode=sample_mode),
    }


def trusted_to_curated(spark: SparkSession, trusted_prefix: str, curated_prefix: str,
                       preview: bool = False, **params) -> dict[str, int]:
    """Read four trusted tables (of one version), answer D1-D6, publish six curated tables
    together as the zone's next version. Returns row counts observed during the writes."""
    trusted = read_tables(spark, trusted_prefix, ("movies", "movie_genres", "people", "movie_reviews"))
    size_shuffle_for(spark, *trusted.values())
    out = Zone(spark, curated_prefix).draft()
    counts = {}
    for name, df in curated_tables(trusted, **params).items():
        counts[name] = out.write(df, name)
        if preview:
            show_top(out.table(name), 20, name)
    out.publish()
    return counts


def sql_questions(spark: SparkSession, trusted_prefix: str | None = None,
                  views: dict | None = None, code: str = "COP") -> dict[str, DataFrame]:
    """S11 + Q1-Q5: register the trusted views (unless ``views`` are given) and return
    the five SQL answers as DataFrames."""
    v = views or register_trusted(spark, trusted_prefix)
    joined = ("movies", "movie_genres")
    dealt = register_views(dict(zip(joined, dealt_alike("tmdb_id", *[spark.table(v[n]) for n in joined]))), prefix="dealt_")
    return {
        "q1_genre_revenue": spark.sql(QS.q1_genre_revenue(v=v | dealt)),
        "q2_profitable_actors": spark.sql(QS.q2_profitable_actors(v=v)),
        "q3_revenue_by_year_rate": spark.sql(QS.q3_revenue_by_year_rate(v=v)),
        "q4_director_roi_fx": spark.sql(QS.q4_director_roi_fx(code=code, v=v)),
        "q5_correlations": spark.sql(QS.q5_correlations(v=v)),
    }
