"""Reference-shaped fixtures (FIXTURES.md §2) through staging, marts and checks."""
import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from marquee.functions import json as J
from marquee.operators import marts, measures, quality, staging

from core_rows import rows

RAW_SCHEMA = ("id string, revenue_date date, title string, revenue string, theaters string, "
              "distributor string, _loaded_at timestamp_ntz")
T0 = dt.datetime(2024, 1, 1, 8)
T1 = dt.datetime(2024, 1, 2, 8)


def raw(spark, data):
    return spark.createDataFrame(data, RAW_SCHEMA)


def doc(title, year, imdb, status="found", **body):
    b = {"Response": "True", "Type": "movie", "imdbID": imdb, "Title": title.upper()}
    b.update(body)
    env = {"_lookup": {"title": title, "year": year}, "_status": status,
           "_fetched_at": "2024-01-03T10:00:00+00:00"}
    env.update(b)
    return json.dumps({k: v for k, v in env.items() if v is not None})


def docs(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    return staging.docs_table(df.select(J.parse("j").alias("v")))


def test_dedupe_latest_and_ties(spark):
    r = raw(spark, [
        ("1", dt.date(2003, 1, 1), "A", "10", "1", "D1", T0),
        ("1", dt.date(2003, 1, 1), "A", "20", "1", "D1", T1),   # later load wins
        ("2", dt.date(2003, 1, 2), "A", "5", "1", "D1", T0),
        ("2", dt.date(2003, 1, 2), "A", "7", "1", "D1", T0),    # tie on time: payload decides
    ])
    s = staging.stg_revenues(r)
    assert rows(s, "id", "revenue") == [("1", Decimal(20)), ("2", Decimal(7))]


def test_hot_id_folds(spark):
    data = [("9", dt.date(2003, 1, 1), "A", str(i), "1", "D", T0) for i in range(2000)]
    s = staging.stg_revenues(raw(spark, data))
    assert rows(s, "id", "revenue") == [("9", Decimal(1999))]


def test_title_spacing_and_release_year(spark):
    r = raw(spark, [
        ("1", dt.date(2004, 3, 1), "  A   B ", "1", "1", "D", T0),
        ("2", dt.date(2003, 12, 30), "A\tB", "1", "1", "D", T0),
        ("3", dt.date(2004, 1, 5), "C", "1", "1", "D", T0),
    ])
    got = rows(staging.stg_revenues(r), "id", "title", "release_year")
    assert got == [("1", "A B", 2003), ("2", "A B", 2003), ("3", "C", 2004)]


def test_bad_number_fails(spark):
    import pytest
    r = raw(spark, [("1", dt.date(2003, 1, 1), "A", "abc", "1", "D", T0)])
    with pytest.raises(Exception):
        staging.stg_revenues(r).collect()


def test_docs_flatten_edges(spark):
    d = docs(spark, [
        doc("A", 2003, "tt1", Runtime="181 min", imdbRating="8.4", imdbVotes="1,234",
            GrossRevenue="$858,373,000", Metascore="N/A",
            Ratings=[{"Source": "Rotten Tomatoes", "Value": "87%"}, {"Source": "X", "Value": "5/10"}]),
        doc("B", 2003, "tt2", Director="N/A", Ratings=[]),                       # empty ratings
        doc("C", 2003, "tt3", Ratings=[{"Source": "Metacritic", "Value": "50/100"}]),
        doc("D", 2003, "tt4", Ratings=[{"Source": "Rotten Tomatoes", "Value": "N/A"}]),
        doc("E", 2003, "tt5"),                                                   # no Ratings key
        doc("F", 2003, "tt6", Type="series"),                                    # dropped
        doc("G", 2003, None, status="not_found", Response="False"),             # dropped
        json.dumps({"_lookup": {"title": "H", "year": 2003}, "_status": "found",
                    "imdbID": "tt8", "type": "movie"}),                          # 'type' != 'Type'
    ])
    s = staging.stg_docs(d)
    got = {r.imdb_id: r for r in s.collect()}
    assert sorted(got) == ["tt1", "tt2", "tt3", "tt4", "tt5"]
    a = got["tt1"]
    assert (a.runtime_min, a.imdb_rating, a.imdb_votes, a.box_office_omdb, a.metascore,
            a.rotten_tomatoes_score) == (Decimal(181), Decimal("8.4"), Decimal(1234),
                                         Decimal(858373000), None, Decimal(87))
    assert got["tt2"].director is None
    assert all(got[k].rotten_tomatoes_score is None for k in ("tt2", "tt3", "tt4", "tt5"))
    assert a._fetched_at == dt.datetime(2024, 1, 3, 10)


def _star(spark, raw_rows, doc_texts):
    stg = staging.stg_revenues(raw(spark, raw_rows))
    d = staging.stg_docs(docs(spark, doc_texts))
    return stg, marts.build_marts(stg, d, marts.dim_date(spark))


def test_star_semantics(spark):
    raw_rows = [
        ("1", dt.date(2003, 1, 1), "A", "100", "10", "D1", T0),
        ("2", dt.date(2004, 1, 1), "A", "50", "5", "D1", T0),
        ("3", dt.date(2003, 2, 1), "U", "70", "5", "D1", T0),    # unenriched title
        ("4", dt.date(2003, 3, 1), "A", "30", "5", None, T0),    # NULL distributor
    ]
    stg, m = _star(spark, raw_rows, [doc("A", 2003, "tt1", imdbRating="7.0")])
    fact = m["fact_daily_revenue"]
    assert rows(fact, "source_row_id", "movie_key", "date_key") == [
        ("1", "tt1", 20030101), ("2", "tt1", 20040101)]
    dist = m["dim_distributor"].first()
    assert (dist.distributor_name, dist.films_distributed_n, dist.lifetime_revenue) == ("D1", 2, Decimal(220))
    mv = m["dim_movie"].first()
    assert (mv.release_year, mv.lifetime_revenue, mv.first_revenue_date) == (2003, Decimal(180), dt.date(2003, 1, 1))
    summ = {r.check_name: r.failures for r in quality.summary(quality.star_checks(m, stg, "2024-01-30")).collect()}
    assert set(summ.values()) == {0}
    # D20 differs from the fact sum: the dim counts the unenriched title too.
    assert measures.revenue_by_distributor(m["dim_distributor"]).first().lifetime_revenue == 220
    assert fact.agg(F.sum("revenue")).first()[0] == 150


def test_duplicate_lookups_fan_out_and_fail_unique(spark):
    raw_rows = [("1", dt.date(2003, 1, 1), "A", "100", "10", "D1", T0)]
    stg, m = _star(spark, raw_rows, [doc("A", 2003, "tt1"), doc("A", 2003, "tt1")])
    assert m["fact_daily_revenue"].count() == 2
    checks = quality.star_checks(m, stg, "2024-01-30")
    assert quality.failures(checks["unique_dim_movie_imdb_id"], "u").first().failures == 1
    assert quality.failures(checks["unique_fact_source_row_id"], "u").first().failures == 1


def test_two_lookups_one_imdb_id(spark):
    raw_rows = [("1", dt.date(2003, 1, 1), "A", "1", "1", "D", T0), ("2", dt.date(2003, 1, 1), "B", "1", "1", "D", T0)]
    stg, m = _star(spark, raw_rows, [doc("A", 2003, "tt1"), doc("B", 2003, "tt1")])
    checks = quality.star_checks(m, stg, "2024-01-30")
    assert checks["unique_dim_movie_imdb_id"].count() == 1


def test_check_failures_reported(spark):
    raw_rows = [
        ("1", dt.date(2030, 1, 1), "A", "-5", "1", "D1", T0),   # future, negative, outside calendar
        ("2", dt.date(2003, 1, 1), "A", None, "1", "D1", T0),   # NULL revenue passes
        ("3", dt.date(2003, 1, 1), "A", "1", "1", "D1", T0),    # grain duplicate of id 2
    ]
    stg, m = _star(spark, raw_rows, [doc("A", 2003, "tt1", imdbRating="0.5")])
    summ = {r.check_name: (r.failures, r.status)
            for r in quality.summary(quality.star_checks(m, stg, "2024-01-30")).collect()}
    assert summ["no_future_revenue_dates"] == (1, "fail")
    assert summ["expression_is_true_fact_revenue"] == (1, "fail")
    assert summ["relationships_fact_date_key"] == (1, "fail")
    assert summ["accepted_range_dim_movie_imdb_rating"] == (1, "fail")
    assert summ["unique_combination_stg_revenues"] == (1, "fail")
    assert summ["not_null_fact_movie_key"] == (0, "pass")
    import pytest
    with pytest.raises(RuntimeError):
        quality.gate(quality.summary(quality.star_checks(m, stg, "2024-01-30")))


def test_null_rating_passes_range(spark):
    df = spark.createDataFrame([(None,), (1.0,), (10.0,)], "r double")
    assert quality.accepted_range(df, "r", 1.0, 10.0).count() == 0
    assert quality.relationships(spark.createDataFrame([(None,), (1,)], "k int"), "k",
                                 spark.createDataFrame([(1,)], "k int"), "k").count() == 0


def test_freshness_of_an_empty_source_is_an_error(spark):
    from marquee.operators import quality
    empty = spark.createDataFrame([], "t timestamp_ntz")
    r = quality.freshness("raw.revenues", empty, "t", "2024-01-30 12:00:00").first()
    assert (r.status, r.max_loaded_at, r.age_hours) == ("error", None, None)


def test_revenue_outside_the_calendar_and_small_sums_are_kept(spark):
    import datetime as dt
    from marquee.operators import measures
    fact = spark.createDataFrame([(dt.date(2025, 12, 31), 10), (dt.date(2026, 1, 1), 7)], "revenue_date date, revenue int")
    cal = spark.createDataFrame([(dt.date(2025, 12, 31), 2025, 4, 12, 31)],
                                "date date, year int, quarter int, month int, day int")
    total = [r.revenue for r in measures.revenue_drill(fact, cal).collect() if r.level == 15]
    assert total == [17]
    small = spark.createDataFrame([(0.004,)] * 3, "x double")
    assert abs(measures.default_sums(small, ["x"]).first()[0] - 0.012) < 1e-12


def test_top_film_fails_rather_than_cuts_ties(spark):
    import pytest
    from marquee.operators import measures
    fact = spark.createDataFrame([(f"k{i}", 5) for i in range(4)], "movie_key string, revenue int")
    movies = spark.createDataFrame([(f"k{i}", f"T{i}") for i in range(4)], "imdb_id string, title string")
    assert measures.top_film(fact, movies).first()[0] == "T0T1T2T3"
    with pytest.raises(Exception, match="tie for the top"):
        measures.top_film(fact, movies, max_ties=3).collect()


def test_freshness_levels(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 29, 0),)], "t timestamp_ntz")
    r = quality.freshness("raw.revenues", df, "t", "2024-01-30 12:00:00").first()
    assert (r.age_hours, r.status) == (36.0, "pass")
    r = quality.freshness("raw.revenues", df, "t", "2024-01-31 00:00:01").first()
    assert r.status == "warn"
    r = quality.freshness("raw.revenues", df, "t", "2024-02-01 00:00:01").first()
    assert r.status == "error"


def test_measures(spark):
    raw_rows = [
        ("1", dt.date(2003, 1, 1), "A", "100", "10", "D1", T0),
        ("2", dt.date(2003, 1, 2), "B", "100", "10", "D1", T0),
        ("3", dt.date(2003, 4, 2), "C", "50", "10", "D1", T0),
    ]
    stg, m = _star(spark, raw_rows, [doc("A", 2003, "tt1", imdbRating="8.0", Director="X"),
                                     doc("B", 2003, "tt2", imdbRating="6.0", Director="X"),
                                     doc("C", 2003, "tt3", imdbRating=None)])
    f, mv = m["fact_daily_revenue"], m["dim_movie"]
    assert measures.top_film(f, mv).first().top_film == "AB"
    k = measures.kpi_cards(f, mv).first()
    assert (k.total_revenue, k.total_revenue_m, k.films_count, k.films_enriched) == (250, 0.00025, 3, 3)
    assert abs(k.avg_daily_revenue - 250 / 3) < 1e-6 and k.avg_imdb_rating == 7.0
    assert measures.date_range_text(f).first().date_range == "2003-01-01  →  2003-04-02"
    drill = {(r.level, r.year, r.quarter): r.revenue
             for r in measures.revenue_drill(f, m["dim_date"]).collect() if r.level in (3, 7, 15)}
    assert drill == {(3, 2003, "Qtr 1"): 200, (3, 2003, "Qtr 2"): 50, (7, 2003, None): 250,
                     (15, None, None): 250}
    leaf = measures.revenue_drill(f, m["dim_date"]).where("level = 0").agg(F.sum("revenue")).first()[0]
    assert leaf == 250
    assert rows(measures.revenue_by_director(f, mv)) == [(None, 50), ("X", 200)]


def test_distributor_films_and_outer_flatten(spark):
    raw_rows = [(str(i), dt.date(2003, 1, 1), f"T{i % 40}", "1", "1", "D1", T0) for i in range(400)]
    stg = staging.stg_revenues(raw(spark, raw_rows))
    assert marts.dim_distributor(stg).first().films_distributed_n == 40
    d = docs(spark, [doc("A", 2003, "tt1"), doc("B", 2003, "tt2", Ratings=[])])
    assert staging.ratings_score(d).count() == 0
    assert sorted(r.imdb_id for r in staging.ratings_score(d, outer=True).collect()) == ["tt1", "tt2"]


def test_fused_checks_equal_separate_checks(spark):
    raw_rows = [
        ("1", dt.date(2030, 1, 1), "A", "-5", "1", "D1", T0),
        ("2", dt.date(2003, 1, 1), "A", None, "1", "D1", T0),
        ("3", dt.date(2003, 1, 1), "A", "1", "1", "D1", T0),
        ("4", dt.date(2003, 1, 2), "B", "1", "1", None, T0),
    ]
    stg, m = _star(spark, raw_rows, [doc("A", 2003, "tt1", imdbRating="0.5"), doc("A", 2003, "tt1")])
    sep = rows(quality.summary(quality.star_checks(m, stg, "2024-01-30")))
    fused = rows(quality.star_summary(m, stg, "2024-01-30"))
    assert sep == fused
    assert any(r[2] == "fail" for r in fused)


def test_cross_filters(spark):
    raw_rows = [
        ("1", dt.date(2003, 1, 1), "A", "100", "1", "D1", T0),
        ("2", dt.date(2003, 2, 1), "A", "10", "1", "D2", T0),
        ("3", dt.date(2003, 2, 2), "B", "5", "1", "D2", T0),
    ]
    stg, m = _star(spark, raw_rows, [doc("A", 2003, "tt1", Director="X"), doc("B", 2003, "tt2", Director="Y")])
    f, mv, dist, cal = m["fact_daily_revenue"], m["dim_movie"], m["dim_distributor"], m["dim_date"]
    feb = cal.where("year = 2003 AND month = 2")
    by_dir = rows(measures.revenue_by_director(measures.restrict_fact(f, calendar=feb), mv))
    assert by_dir == [("X", 10), ("Y", 5)]
    d2 = dist.where("distributor_name = 'D2'")
    ff = measures.restrict_fact(f, distributors=d2)
    assert rows(measures.cross_filter_dim(mv, "imdb_id", ff, "movie_key"), "imdb_id") == [("tt1",), ("tt2",)]
    only_x = measures.filter_movies(mv, director="X")
    k = measures.kpi_cards(measures.restrict_fact(f, movies=only_x), only_x).first()
    assert (k.total_revenue, k.films_count, k.films_enriched) == (110, 1, 1)
    # both directions: distributors that still have rows under the movie filter
    assert rows(measures.cross_filter_dim(dist, "distributor_key", measures.restrict_fact(
        f, movies=measures.filter_movies(mv, director="Y")), "distributor_key"), "distributor_name") == [("D2",)]
