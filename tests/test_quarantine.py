"""Refused rows keep their raw text and a reason; they are what the cleaners drop."""

import json

import pytest

from trilake.plans.quarantine import TYPED, judged, rejected_rows
from trilake.plans.trusted import ROW_CLEANERS, raw_to_trusted
from trilake.sources.parquet import read_table
from trilake.sources.raw_csv import land_raw

IDS = ["1", " 2 ", "3.0", None, "", "N/A", "abc", "1e3", "0", "-5", "0.7", "99999999999999999999", "\t4\n"]


@pytest.mark.parametrize("table,key", [("movies", "tmdb_id"), ("tv_shows", "tmdb_id"), ("people", "tmdb_id"), ("movie_reviews", "review_id")])
def test_refused_is_what_the_cleaner_drops(spark, table, key):
    raw = spark.createDataFrame([(v, str(i)) for i, v in enumerate(IDS)], f"{key} string, mark string")
    kept = {r.mark for r in ROW_CLEANERS[table][0](raw.withColumn("rating", raw.mark)).collect()}
    refused = rejected_rows(raw.withColumn("rating", raw.mark), table).collect()
    marks = {json.loads(r.record)["mark"] for r in refused}
    assert kept | marks == {str(i) for i in range(len(IDS))} and not kept & marks and marks
    why = {json.loads(r.record)[key]: r.reason.split(" is ")[1] for r in refused}
    if key == "tmdb_id":
        assert why == {None: "missing", "": "missing", "N/A": "missing", "abc": "no number", "1e3": "no number", "0": "not positive", "-5": "not positive",
                       "0.7": "not positive", "99999999999999999999": "no number"}
    else:
        assert why == {None: "missing", "": "missing", "N/A": "missing"}


def test_rates(spark):
    rows = [("COP", "4"), (None, "1"), ("null", "1"), ("USD", None), ("USD", "nan"), ("USD", "x"), ("USD", "0"), ("USD", "-1"), (" eur ", "2")]
    raw = spark.createDataFrame(rows, "currency string, rate string")
    kept = sorted(r.currency for r in ROW_CLEANERS["exchange"][0](raw).collect())
    assert kept == ["COP", "EUR"] and sorted(r.reason for r in rejected_rows(raw, "exchange").collect()) == [
        "currency is missing", "currency is missing", "rate is missing", "rate is missing", "rate is no number", "rate is not positive", "rate is not positive"]
    assert judged(raw, "exchange").count() == len(rows) and set(TYPED) == set(ROW_CLEANERS)


def test_the_job_keeps_its_refused_rows(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    ids = [(v, "1", "9", "a,b") for v in IDS]
    land_raw(spark.createDataFrame(ids, "tmdb_id string, popularity string, revenue_usd string, genres string").selectExpr("*", "'3' AS budget_usd"), raw, "movies", "r0")
    land_raw(spark.createDataFrame(ids, "tmdb_id string, popularity string, title string, genres string"), raw, "tv_shows", "r0")
    land_raw(spark.createDataFrame(ids[:3], "tmdb_id string, popularity string, name string, total_movie_credits string"), raw, "people", "r0")
    land_raw(spark.createDataFrame([("r1", "1", "5"), ("r2", "77", "5"), ("", "1", "5")], "review_id string, tmdb_id string, rating string"), raw, "movie_reviews", "r0")
    land_raw(spark.createDataFrame([("COP", "4"), ("cop", "x")], "currency string, rate string"), raw, "exchange", "r0")
    plain = raw_to_trusted(spark, raw, f"{tmp_dir}/plain")
    counts = raw_to_trusted(spark, raw, f"{tmp_dir}/kept", quarantine=True)
    assert counts["rejected_rows"] == 9 + 9 + 0 + 1 + 1 and plain["movies_rejected"] == 9
    for name in ("movies", "tv_shows", "people", "movie_reviews", "exchange", "movie_genres"):
        a, b = (read_table(spark, f"{tmp_dir}/{p}", name) for p in ("plain", "kept"))
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and counts[name] == plain[name]
    refused = read_table(spark, f"{tmp_dir}/kept", "rejected_rows")
    assert refused.where("table_name = 'exchange'").first().reason == "rate is no number"
    assert json.loads(refused.where("table_name = 'movie_reviews'").first().record) == {"review_id": None, "tmdb_id": "1", "rating": "5", "run_ts": "r0"}
