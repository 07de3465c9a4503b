"""Golden end-to-end: hand-built raw CSVs -> trusted -> curated, hand-computed answers,
plus the DataFrame / SQL variant differences of SURVEY §2.12."""

import os

import pytest

from tests.conftest import rows
from trilake.plans.curated import curated_tables, sql_questions, trusted_to_curated
from trilake.plans.trusted import raw_to_trusted
from trilake.sources.parquet import read_table
from trilake.sources.views import register_views

MOVIES_1 = '''tmdb_id,title,release_year,vote_count,popularity,vote_average,budget_usd,revenue_usd,genres,cast_ids,directors,has_trailer
1,Alpha,1990,100,5.0,7.0,100,300,"Drama ,Comedy","10,11",Ann,yes
2,Beta,1990,50,4.0,6.0,200,100,drama,"10, x",Ann,no
3,Gamma,1990,10,3.0,8.0,50,150,"Comedy,,Action",11,"Ann, Bob",TRUE
4,Delta,1979,10,1.0,5.0,10,40,Drama,10,Bob,0
5,Eps,1990,10,1.0,9.0,-5,20,N/A,,Bob,1
0,Zero,1990,1,1.0,1.0,1,1,Drama,10,Ann,1
-1,Neg,1990,1,1.0,1.0,1,1,Drama,10,Ann,1
1,Alpha old,1985,999,9.0,7.0,100,300,Drama,10,Ann,1
6,"Quote ""Six""",1990,10,1.0,4.0,0,50,"Action","12",Cy,1
7,"Multi
line",1990,10,1.0,4.5,100,0,Drama,12,Cy,1
'''

PEOPLE = '''tmdb_id,name,popularity,total_movie_credits
10,Actor Ten,1.0,5
11,Actor Eleven,2.0,5
11,Actor Eleven dup,1.0,9
12,Actor Twelve,1.0,1
abc,Junk,1.0,1
'''

REVIEWS = '''review_id,tmdb_id,rating,created_at,author
r1,1,8,2020-01-01,a
r2,1,9,2020-01-02,b
r3,1,10.5,2020-01-03,c
r4,1,7,2020-01-04,d
r5,3,6,2020-01-01,e
r6,3,7,2020-01-01,f
r7,3,8,2020-01-01,g
r7,3,2,2019-01-01,g
r8,99,5,2020-01-01,h
,1,5,2020-01-01,i
'''

EXCHANGE_1 = '''currency,rate,base,date
cop,4000,USD,2024-01-01
EUR,0.9,USD,2024-01-01
'''
EXCHANGE_2 = '''currency,rate,base,date
COP,4100,USD,2024-01-02
JPY,0,USD,2024-01-02
'''

TV = '''tmdb_id,title,release_year,vote_count,popularity,in_production
1,Show,2000,1,350,true
2,Show2,2000,1,300,false
3,Show3,2000,1,,false
'''


def _land(root, name, run, text):
    d = os.path.join(root, "raw", name, f"run_ts={run}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{name}_{run}.csv"), "w") as f:
        f.write(text)


@pytest.fixture(scope="module")
def lake(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="trilake-golden-")
    _land(root, "movies", "20240101_000000", MOVIES_1)
    _land(root, "people", "20240101_000000", PEOPLE)
    _land(root, "movie_reviews", "20240101_000000", REVIEWS)
    _land(root, "exchange", "20240101_000000", EXCHANGE_1)
    _land(root, "exchange", "20240102_000000", EXCHANGE_2)
    _land(root, "tv_shows", "20240101_000000", TV)
    counts = raw_to_trusted(spark, f"{root}/raw", f"{root}/trusted")
    return root, counts


def test_trusted_counts_and_cleaning(spark, lake):
    root, counts = lake
    assert counts["movies"] == 7            # ids 1..7 (0, -1 dropped, id 1 deduped)
    movies = read_table(spark, f"{root}/trusted", "movies")
    m = {r["tmdb_id"]: r for r in movies.collect()}
    assert m[1]["title"] == "Alpha"         # newer release_year wins over higher vote_count
    assert m[1]["genres"] == "drama, comedy"
    assert m[3]["genres"] == "comedy,  action"   # single-pass rule, empty token removed by the bridge
    assert m[5]["genres"] is None and m[5]["budget_usd"] is None   # N/A list, negative budget
    assert m[6]["title"] == 'Quote "Six"' and m[7]["title"] == "Multi\nline"
    assert m[1]["profit_usd"] == 200.0 and m[1]["roi_pct"] == 300.0
    assert m[6]["roi_pct"] is None          # zero budget
    assert m[1]["revenue_cop"] == 300.0 * 4100.0   # highest COP rate ever landed (B4)
    assert m[2]["has_trailer"] is False and m[3]["has_trailer"] is True
    ex = {r["currency"]: r["rate"] for r in read_table(spark, f"{root}/trusted", "exchange").collect()}
    assert ex == {"COP": 4100.0, "EUR": 0.9}       # JPY rate 0 filtered, code upper-cased
    people = {r["tmdb_id"]: r["name"] for r in read_table(spark, f"{root}/trusted", "people").collect()}
    assert people == {10: "Actor Ten", 11: "Actor Eleven", 12: "Actor Twelve"}
    rv = {r["review_id"]: (r["tmdb_id"], r["rating"])
          for r in read_table(spark, f"{root}/trusted", "movie_reviews").collect()}
    assert rv == {"r1": (1, 8.0), "r2": (1, 9.0), "r3": (1, None), "r4": (1, 7.0),
                  "r5": (3, 6.0), "r6": (3, 7.0), "r7": (3, 8.0)}   # r8 unknown title, empty id dropped
    tv = {r["tmdb_id"]: r["popularity_bucket"] for r in read_table(spark, f"{root}/trusted", "tv_shows").collect()}
    assert tv == {1: "high", 2: "medium", 3: "low"}
    bridge = rows(read_table(spark, f"{root}/trusted", "movie_genres"))
    assert (1, "comedy") in bridge and (3, "action") in bridge and len(bridge) == 8


def test_curated_answers(spark, lake):
    root, _ = lake
    trusted = {n: read_table(spark, f"{root}/trusted", n)
               for n in ("movies", "movie_genres", "people", "movie_reviews")}
    cur = curated_tables(trusted, sample_mode="hash")
    g = {r["genre"]: r for r in cur["revenue_by_genre"].collect()}
    # revenue > 0: titles 1,2,3,4,6 (7 has revenue 0)
    assert g["drama"]["n_movies"] == 3 and g["drama"]["revenue_usd_total"] == 440.0
    assert g["comedy"]["revenue_usd_avg"] == 225.0
    assert g["action"]["n_movies"] == 2
    # profitable titles: 1 (cast 10,11), 3 (11), 4 (10), 6 (12 with budget 0 -> profit 50)
    a = {r["actor_id"]: (r["n_movies_rentables"], r["avg_profit_usd"]) for r in cur["top_actors_rentables"].collect()}
    assert a == {10: (2, 115.0), 11: (2, 150.0), 12: (1, 50.0)}
    y = {r["release_year"]: r["n_movies"] for r in cur["revenue_by_year"].collect()}
    assert y == {1990: 6}                   # 1979 excluded, 1990 has >= 5 titles with revenue
    d = {r["director_name"]: r["n_movies"] for r in cur["roi_by_director"].collect()}
    assert d == {"Ann": 3}                  # Bob has 2 titles with ROI (5 has none), Cy 1
    corr = cur["ratings_correlations"].first()
    assert corr["corr_reviews_revenue"] is not None and -1 <= corr["corr_tmdb_revenue"] <= 1
    assert cur["ratings_vs_revenue_sample"].count() == 6   # titles 1-6 have rating and revenue > 0


def test_curated_job_writes_six_tables(spark, lake):
    root, _ = lake
    counts = trusted_to_curated(spark, f"{root}/trusted", f"{root}/curated", sample_mode="hash")
    assert set(counts) == {"revenue_by_genre", "top_actors_rentables", "revenue_by_year",
                           "roi_by_director", "ratings_correlations", "ratings_vs_revenue_sample"}
    assert counts["ratings_correlations"] == 1


def test_sql_variants_differ_where_documented(spark, lake):
    root, _ = lake
    trusted = {n: read_table(spark, f"{root}/trusted", n)
               for n in ("movies", "movie_genres", "people", "movie_reviews", "exchange")}
    v = register_views(trusted, prefix="gold_")
    sq = sql_questions(spark, views=v)
    cur = curated_tables(trusted, sample_mode="hash")
    # Q1 allows zero revenue: title 7 (drama, revenue 0) counts in SQL only
    q1 = {r["genre"]: r["num_peliculas"] for r in sq["q1_genre_revenue"].collect()}
    d1 = {r["genre"]: r["n_movies"] for r in cur["revenue_by_genre"].collect()}
    assert q1["drama"] == d1["drama"] + 1
    # Q3 covers all years (1979 has one title, below the 5-title floor) and reports the rate
    q3 = sq["q3_revenue_by_year_rate"].collect()
    assert [r["release_year"] for r in q3] == [1990] and abs(q3[0]["tasa_cop_aplicada"] - 4100) < 1e-6
    # Q4: adjusted ROI = ROI - 100
    for r in sq["q4_director_roi_fx"].collect():
        assert abs(r["avg_roi_adjusted_cop"] - (r["avg_roi_pct"] - 100)) < 0.011
    # Q2 agrees with D2 on counts
    q2 = {r["tmdb_id"]: r["peliculas_rentables"] for r in sq["q2_profitable_actors"].collect()}
    d2 = {r["actor_id"]: r["n_movies_rentables"] for r in cur["top_actors_rentables"].collect()}
    assert q2 == d2
    # Q5 inner join: only reviewed titles (1 and 3) -> two points, defined TMDB coefficients
    q5 = sq["q5_correlations"].first()
    assert q5["corr_nota_tmdb_vs_revenue"] is not None


def test_q4_empty_without_rate(spark, lake):
    root, _ = lake
    trusted = {n: read_table(spark, f"{root}/trusted", n)
               for n in ("movies", "movie_genres", "people", "movie_reviews", "exchange")}
    v = register_views(trusted, prefix="gold2_")
    assert sql_questions(spark, views=v, code="GBP")["q4_director_roi_fx"].count() == 0


def test_d1_bridge_join_equals_inline_explode(spark, lake):
    root, _ = lake
    trusted = {n: read_table(spark, f"{root}/trusted", n)
               for n in ("movies", "movie_genres", "people", "movie_reviews")}
    a = curated_tables(trusted, sample_mode="hash", use_bridge=True)["revenue_by_genre"]
    b = curated_tables(trusted, sample_mode="hash", use_bridge=False)["revenue_by_genre"]
    assert rows(a) == rows(b)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_dashboard_feeds_from_curated_zone(spark, lake):
    from trilake.plans.kpi import dashboard_feeds
    root, _ = lake
    trusted_to_curated(spark, f"{root}/trusted", f"{root}/curated_dash", sample_mode="hash")
    feeds = dashboard_feeds(spark, f"{root}/curated_dash")
    k = feeds["kpis"].first()
    assert k["n_movies"] == 6
    assert feeds["kpi_text"].first()["n_movies_text"] == "6"
    assert feeds["axis_ranges"].count() == 3
    assert [r["Año"] for r in feeds["years"].collect()] == [1990]
    assert feeds["genres"].count() == 3


def test_bucketed_trusted_job_gives_same_answers(spark, lake):
    root, counts = lake
    bcounts = raw_to_trusted(spark, f"{root}/raw", f"{root}/trusted_b", buckets=4)
    assert bcounts == counts
    names = ("movies", "movie_genres", "people", "movie_reviews")
    plain = curated_tables({n: read_table(spark, f"{root}/trusted", n) for n in names},
                           sample_mode="hash", use_bridge=True)
    bucketed = curated_tables({n: read_table(spark, f"{root}/trusted_b", n) for n in names},
                              sample_mode="hash", use_bridge=True)
    for name in plain:
        assert rows(plain[name]) == rows(bucketed[name]), name


def test_d2_preaggregated_plan_equals_reference_plan(spark, lake):
    from trilake.plans import questions as Q
    root, _ = lake
    movies = read_table(spark, f"{root}/trusted", "movies")
    people = read_table(spark, f"{root}/trusted", "people")
    assert rows(Q.top_actors_rentables(movies, people)) == \
        rows(Q.top_actors_rentables(movies, people, people_unique=False))
