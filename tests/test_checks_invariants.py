"""Checks of the checks, star invariants on the driver data, property tests."""
import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.operators import measures, quality, skew, staging
from marquee.plans.build import star

SF = "/root/testdata/sf0.01"

# (check, passing rows, failing rows) over one column "x" (and "y" for the combination)
CASES = [
    (lambda df: quality.not_null(df, "x"), [(1, 1), (2, 1)], [(None, 1)]),
    (lambda df: quality.unique(df, "x"), [(1, 1), (2, 1), (None, 1), (None, 1)], [(1, 1), (1, 2)]),
    (lambda df: quality.unique_combination(df, ["x", "y"]), [(1, 1), (1, 2)], [(None, 1), (None, 1)]),
    (lambda df: quality.accepted_range(df, "x", 1, 10), [(1, 1), (10, 1), (None, 1)], [(11, 1)]),
    (lambda df: quality.expression_is_true(df, "x >= 0"), [(0, 1), (None, 1)], [(-1, 1)]),
]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_check_pass_and_fail(spark, i):
    check, ok, bad = CASES[i]
    schema = "x int, y int"
    assert check(spark.createDataFrame(ok, schema)).count() == 0
    assert check(spark.createDataFrame(bad, schema)).count() > 0


def test_relationships_and_future(spark):
    child = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    assert [r.k for r in quality.relationships(child, "k", parent, "k").collect()] == [3]
    d = spark.createDataFrame([(dt.date(2024, 1, 30),), (dt.date(2024, 1, 31),)], "d date")
    assert quality.future_dates(d, "d", "2024-01-30").count() == 1


def test_star_invariants(spark):
    s = star(spark, SF)
    stg, fact, movies, dists, cal = (s["stg_revenues"], s["fact_daily_revenue"], s["dim_movie"],
                                     s["dim_distributor"], s["dim_date"])
    assert fact.count() <= stg.count()
    assert quality.unique(fact, "source_row_id").count() == 0
    leaf = measures.revenue_drill(fact, cal).where("level = 0").agg(F.sum("revenue")).first()[0]
    total = measures.kpi_cards(fact, movies).first().total_revenue
    assert leaf == total
    for col, parent, field in (("movie_key", movies, "imdb_id"), ("date_key", cal, "date_key"),
                               ("distributor_key", dists, "distributor_key")):
        assert quality.relationships(fact, col, parent, field).count() == 0


rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3), st.integers(0, 5)),
    min_size=1, max_size=30)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy)
def test_dedupe_latest_matches_python(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = sorted(tuple(r) for r in staging.dedupe_latest(df, "k", ["t", "v"], ["t", "v"]).collect())
    want = {}
    for k, t, v in rows:
        want[k] = max(want.get(k, (t, v)), (t, v))
    assert got == sorted((k, t, v) for k, (t, v) in want.items())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=st.lists(st.sampled_from(["h", "h", "h", "x", "y", None]), min_size=1, max_size=60))
def test_salted_join_matches_plain(spark, keys):
    big = spark.createDataFrame(list(enumerate(keys)), "id long, k string")
    small = spark.createDataFrame([("h", 1), ("x", 2), (None, 3)], "k string, v int")
    counts = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = skew.hot_keys(counts, ["k"], partitions=4)
    got = sorted(tuple(r) for r in skew.salted_join(big, small, ["k"], hot, ["id"], "left")
                 .select("id", "v").collect())
    want = sorted((i, {"h": 1, "x": 2}.get(k)) for i, k in enumerate(keys))
    assert got == want


def test_sql_over_registered_views(spark):
    s = star(spark, SF)
    for name, df in s.items():
        df.createOrReplaceTempView(f"v_{name}")
    top = spark.sql("""
        SELECT d.distributor_name, SUM(f.revenue) AS rev
        FROM v_fact_daily_revenue f JOIN v_dim_distributor d USING (distributor_key)
        GROUP BY d.distributor_name ORDER BY rev DESC, d.distributor_name LIMIT 3""").collect()
    assert len(top) == 3 and top[0].rev >= top[1].rev >= top[2].rev
    n = spark.sql("SELECT COUNT(*) AS n FROM v_dim_date WHERE is_weekend").first().n
    assert n > 0


def test_changed_input_is_built_again(spark, tmp_path):
    for t in ("lineitem", "part", "supplier"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    first = star(spark, str(tmp_path))
    assert star(spark, str(tmp_path)) is first
    n = first["stg_revenues"].count()
    half = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_orderkey % 2 = 0")
    half.write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert 0 < star(spark, str(tmp_path))["stg_revenues"].count() < n
