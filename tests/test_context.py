"""Filter context: directions, several filters, blank values, role calendars, pruned partitions."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from marquee.operators import context as C
from marquee.operators import marts
from marquee.session import scratch_path


@pytest.fixture(scope="module")
def model(spark):
    movie = ", ".join(f"{c} string" for c in ("imdb_id", "title", "director")) + \
        ", first_revenue_date date, last_revenue_date date, omdb_fetched_at timestamp_ntz"
    at = dt.datetime(2024, 1, 30, 23, 59)
    movies = spark.createDataFrame([
        ("m1", "A", "X", dt.date(2003, 1, 1), dt.date(2003, 3, 1), at), ("m2", "B", "Y", dt.date(2004, 1, 1), dt.date(2004, 1, 1), at),
        ("m3", "C", None, dt.date(2003, 2, 1), dt.date(2003, 2, 1), None)], movie)
    dists = spark.createDataFrame([("d1", "Fox", 10), ("d2", "Sun", 20), ("d3", "Idle", 30)],
                                  "distributor_key string, distributor_name string, lifetime_revenue long")
    days = [("m1", "d1", dt.date(2003, 1, 1), 5), ("m1", "d2", dt.date(2003, 3, 1), 7), ("m2", "d2", dt.date(2004, 1, 1), 11),
            ("m3", "d1", dt.date(2003, 2, 1), 13), ("gone", "d1", dt.date(2004, 5, 1), 17)]
    fact = spark.createDataFrame([(m, d, t.year * 10000 + t.month * 100 + t.day, t, r) for m, d, t, r in days],
                                 "movie_key string, distributor_key string, date_key int, revenue_date date, revenue long")
    return C.star_model({C.FACT: fact, C.MOVIE: movies, C.DISTRIBUTOR: dists,
                         C.DAY: marts.dim_date(spark, "2003-01-01", "2005-01-01")})


def names(df):
    return sorted(r[0] for r in df.select("distributor_name").collect())


def test_filters_flow_from_one_to_many_and_back_where_both(model):
    ctx = C.FilterContext(model)
    by_director = ctx.page(director="X")
    assert by_director.rows(C.FACT).count() == 2
    assert names(by_director.rows(C.DISTRIBUTOR)) == ["Fox", "Sun"]
    assert by_director.rows(C.DAY).count() == ctx.rows(C.DAY).count()  # days are not narrowed: one direction
    by_name = ctx.page(distributor="Sun")
    assert by_name.rows(C.MOVIE).count() == 3 and by_name.rows(C.FACT).count() == 2
    assert names(ctx.rows(C.DISTRIBUTOR)) == ["Fox", "Idle", "Sun"]
    on_fact = ctx.where(C.FACT, F.col("revenue") > 12)
    assert names(on_fact.rows(C.DISTRIBUTOR)) == ["Fox"]


def test_filters_hold_together_and_blank_is_a_value(model):
    ctx = C.FilterContext(model)
    one = ctx.page(year=[2003], distributor=["Sun", "Fox"]).page(title=lambda c: c != "C")
    assert [tuple(r) for r in one.summary().collect()] == [(12, 2, 1, 2, 2)]
    assert ctx.page(director=None).rows(C.MOVIE).count() == 1
    assert ctx.page(director=[]).summary().collect() == ctx.summary().collect()
    empty = ctx.page(title="nothing").summary().first()
    assert (empty.revenue, empty.n_rows, empty.n_distributors) == (None, 0, 0)
    with pytest.raises(KeyError):
        ctx.where("no_such_table", F.lit(True))


def test_every_date_column_has_its_calendar(model):
    ctx = C.FilterContext(model)
    got = {role: ctx.where(role, F.expr(pick)).rows(C.FACT).agg(F.sum("revenue")).first()[0] for role, pick in (
        ("calendar_date", "year = 2004"), ("calendar_revenue", "month = 2"), ("calendar_first_revenue", "year = 2004"),
        ("calendar_last_revenue", "quarter = 1 AND year = 2003"), ("calendar_fetched", "day = 30"))}
    assert got == {"calendar_date": 28, "calendar_revenue": 13, "calendar_first_revenue": 11,
                   "calendar_last_revenue": 25, "calendar_fetched": 23}


def test_pairs_of_visuals(model):
    picks = {"director": (C.MOVIE, F.col("director") == "X"), "distributor": (C.DISTRIBUTOR, F.col("distributor_name") == "Fox"),
             "film": (C.MOVIE, F.col("title") == "B"), "month": (C.DAY, F.expr("year = 2004 AND month = 5"))}
    got = {}
    for r in C.interact(C.FilterContext(model), picks).collect():
        got.setdefault((r.source, r.target), {})[r.label] = r.revenue
    assert got == {("director", "film"): {"A": 12}, ("director", "distributor"): {"Fox": 10, "Sun": 20},
                   ("director", "month"): {"2003-01": 5, "2003-03": 7}, ("distributor", "film"): {"A": 5, "C": 13},
                   ("distributor", "director"): {"X": 5, None: 30}, ("film", "month"): {"2004-01": 11},
                   ("month", "director"): {None: 17}}


def test_year_filter_prunes_partitions_of_the_fact(spark, model):
    parted = C.year_partitioned(model[C.FACT], f"{scratch_path(spark, 't-by-year')}/fact")
    days = f"{scratch_path(spark, 't-days')}"
    model[C.DAY].write.parquet(days)
    ctx = C.FilterContext({**model, C.FACT: parted, C.DAY: spark.read.parquet(days)})
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")

    def plan(c):
        text = c.rows(C.FACT)._jdf.queryExecution().explainString(mode)
        assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
        return text

    by_year = ctx.page(year=2003)
    assert by_year.rows(C.FACT).count() == 3
    assert re.search(r"PartitionFilters: \[.*\(year#\d+ = 2003\)", plan(by_year))  # known before the query runs
    by_day = ctx.where(C.DAY, F.col("day") == 1, F.col("month") < 3)
    assert by_day.rows(C.FACT).count() == 3
    assert re.search(r"PartitionFilters: \[.*dynamicpruning", plan(by_day))  # known once the days are
