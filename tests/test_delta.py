"""Maintained answers: D1, D3 and D5 after every landing equal the full job's."""

import random

import pytest
from pyspark.sql import functions as F

from trilake.operators.finance import financial_metrics
from trilake.plans import questions as Q
from trilake.plans.delta import MaintainedAnswers
from trilake.streaming.keyed import KeyedTable

MOVIE = "tmdb_id long, release_year int, vote_count int, popularity double, revenue_usd double, budget_usd double, vote_average double, genres string"
REVIEW = "review_id string, tmdb_id long, rating double, created_at string"


def _movie(rng, i, year=None):
    some = lambda v: None if rng.random() < 0.1 else v
    return (i, year or rng.choice([1979, 1990, 1991, 2000]), rng.randrange(9), rng.random(), some(rng.random() * 10 ** rng.randrange(3, 10)), some(rng.choice([0.0, rng.random() * 1e6])),
            some(round(rng.random() * 10, 1)), some(rng.choice(["drama, comedy", "drama", "comedy, comedy, war", " ,", "war"])))


def _review(rng, i):
    return (f"r{i}", rng.randrange(1, 90), None if rng.random() < 0.2 else round(rng.random() * 10, 1), str(rng.randrange(5)))


def _full(spark, movies, reviews, rates):
    ex = rates.rows().select("currency", "rate")
    m = financial_metrics(movies.rows(), ex, "COP")
    r = reviews.rows()
    shape = lambda df: [tuple(x) for x in df.collect()]
    return shape(Q.revenue_by_genre(m)), shape(Q.revenue_by_year(m)), shape(Q.ratings_correlations(m, r))


def _kept(a):
    shape = lambda df: [tuple(x) for x in df.collect()]
    return shape(a.revenue_by_genre()), shape(a.revenue_by_year()), shape(a.ratings_correlations())


def test_answers_follow_the_landings(spark, tmp_dir):
    rng = random.Random(4)
    movies = KeyedTable(spark, f"{tmp_dir}/m", "tmdb_id", ["release_year", "vote_count", "popularity"], buckets=4)
    reviews = KeyedTable(spark, f"{tmp_dir}/r", "review_id", ["created_at"], buckets=4)
    rates = KeyedTable(spark, f"{tmp_dir}/x", "currency", ["rate"], buckets=2)
    answers = MaintainedAnswers(spark, f"{tmp_dir}/a", movies, reviews, rates)
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    rates.merge(frame([("COP", 4.5), ("EUR", 0.9)], "currency string, rate double"), "s", 0)
    movies.merge(frame([_movie(rng, i) for i in range(1, 80)], MOVIE), "s", 0)
    reviews.merge(frame([_review(rng, i) for i in range(300)], REVIEW), "s", 0)
    assert answers.update() and _kept(answers) == _full(spark, movies, reviews, rates)
    assert answers.update() is False  # nothing landed
    # newer rows of known titles (retraction), new titles, two commits at once
    movies.merge(frame([_movie(rng, i, 2001) for i in range(1, 20)] + [_movie(rng, i) for i in range(80, 90)], MOVIE), "s", 1)
    movies.merge(frame([_movie(rng, i, 2002) for i in range(5, 8)], MOVIE), "s", 2)
    assert answers.update() and _kept(answers) == _full(spark, movies, reviews, rates)
    # reviews move between titles and change their ratings; titles stay
    reviews.merge(frame([_review(rng, i)[:3] + ("9",) for i in range(0, 300, 7)], REVIEW), "s", 1)
    assert answers.update() and _kept(answers) == _full(spark, movies, reviews, rates)
    # both at once, and a landing that loses everywhere
    movies.merge(frame([_movie(rng, 3, 1900)], MOVIE), "s", 3)
    movies.merge(frame([_movie(rng, i, 2003) for i in (1, 30, 95)], MOVIE), "s", 4)
    reviews.merge(frame([_review(rng, i) for i in range(300, 340)], REVIEW), "s", 2)
    assert answers.update() and _kept(answers) == _full(spark, movies, reviews, rates)
    # a rate that does not win changes nothing; one that does, everything
    rates.merge(frame([("COP", 4.0)], "currency string, rate double"), "s", 1)
    assert answers.update() is False
    rates.merge(frame([("COP", 5.25)], "currency string, rate double"), "s", 2)
    assert answers.update() and _kept(answers) == _full(spark, movies, reviews, rates)
    movies.merge(frame([_movie(rng, i, 2010) for i in range(40, 50)], MOVIE), "s", 5)
    assert answers.update() and _kept(answers) == _full(spark, movies, reviews, rates)


def test_an_update_that_failed_is_run_again(spark, tmp_dir, monkeypatch):
    rng = random.Random(5)
    movies = KeyedTable(spark, f"{tmp_dir}/m", "tmdb_id", ["release_year"], buckets=2)
    reviews = KeyedTable(spark, f"{tmp_dir}/r", "review_id", ["created_at"], buckets=2)
    rates = KeyedTable(spark, f"{tmp_dir}/x", "currency", ["rate"], buckets=2)
    answers = MaintainedAnswers(spark, f"{tmp_dir}/a", movies, reviews, rates)
    rates.merge(spark.createDataFrame([("COP", 2.0)], "currency string, rate double"), "s", 0)
    movies.merge(spark.createDataFrame([_movie(rng, i) for i in range(1, 40)], MOVIE), "s", 0)
    reviews.merge(spark.createDataFrame([_review(rng, i) for i in range(100)], REVIEW), "s", 0)
    answers.update()
    reviews.merge(spark.createDataFrame([_review(rng, i) for i in range(100, 200)], REVIEW), "s", 1)
    real = answers._pair_change
    monkeypatch.setattr(answers, "_pair_change", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        answers.update()  # the rating sums are already written
    monkeypatch.setattr(answers, "_pair_change", real)
    reviews.merge(spark.createDataFrame([_review(rng, i) for i in range(150, 250)], REVIEW), "s", 2)
    assert answers.update() and _kept(answers) == _full(spark, movies, reviews, rates)


def test_only_touched_buckets_are_read(spark, tmp_dir):
    import re
    rng = random.Random(6)
    movies = KeyedTable(spark, f"{tmp_dir}/m", "tmdb_id", ["release_year"], buckets=16)
    movies.merge(spark.createDataFrame([_movie(rng, i) for i in range(1, 400)], MOVIE), "s", 0)
    answers = MaintainedAnswers(spark, f"{tmp_dir}/a", movies, movies, movies)
    few = answers._of_titles(movies, 1, spark.createDataFrame([(7,), (8,)], "tmdb_id long"))
    assert few.count() == 2 and len(set(re.findall(r"_bucket=\d+", " ".join(movies.rows(1, [1, 2]).inputFiles())))) <= 2
    assert len(set(re.findall(r"_bucket=\d+", " ".join(few.inputFiles())))) <= 2
