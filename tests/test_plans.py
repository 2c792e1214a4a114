"""Physical-plan properties the design relies on (checked with explain)."""
import contextlib
import io

import __spark_entry__ as E
from marquee.plans import standins as S

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_queue_plan_pushdown_anti_topn(spark):
    p = plan(E.queries()["queue_preview"](spark, SF))
    assert "TakeOrderedAndProject" in p                       # distributed top-N
    assert p.count("LeftAnti") >= 2                            # anti joins, not NOT IN
    assert "GreaterThanOrEqual(ts,2024-01-30T00:00)" in p     # same-day filter reaches the scan
    assert "LessThan(ts,2024-01-31T00:00)" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p


def test_staging_has_no_window_over_keys(spark):
    p = plan(S.stg(spark, SF))
    assert "Window" not in p                                   # de-dup and first year are aggregates
    assert "Partial" in p or "partial_" in p                   # map-side partial aggregation
    assert "l_discount" not in p and "l_tax" not in p          # pruned lineitem columns


def test_report_reads_only_needed_mart_columns(spark):
    p = plan(E.queries()["revenue_by_director"](spark, SF))
    assert "ReadSchema: struct<movie_key:string,revenue:decimal(12,0)>" in p
    assert "ReadSchema: struct<imdb_id:string,director:string>" in p


def test_latency_profile_ranks_only_the_bracket(spark):
    p = plan(E.queries()["step_profile"](spark, SF))
    assert "percentile_approx" in p
    # counts by value are cumulated per (step, bracket), after an aggregate; the other
    # window runs over one row per step for the share denominator
    assert "row_number()" not in p
    sums = [ln for ln in p.splitlines() if ln.startswith("Arguments:") and "windowspecdefinition(step" in ln]
    assert sums and all("which" in ln and "sum(c" in ln for ln in sums)


def test_plans_do_not_depend_on_the_size_of_the_input(spark, tmp_path):
    """A table of one row and a table of many files get the same operators."""
    import re

    def operators(path):
        from marquee.sources.tables import read_table
        p = plan(read_table(spark, path, "orders", "o_custkey", "o_totalprice").groupBy("o_custkey").sum("o_totalprice"))
        return re.findall(r"^\(\d+\) (\w+)", p, re.M)

    whole = spark.read.parquet(f"{SF}/orders.parquet")
    whole.limit(1).write.parquet(f"{tmp_path}/one/orders.parquet")
    whole.repartition(40).write.parquet(f"{tmp_path}/many/orders.parquet")
    assert operators(f"{tmp_path}/one") == operators(f"{tmp_path}/many")


def test_hot_keys_are_distinct_before_semi_and_anti_joins(spark):
    from marquee.operators import measures, queue
    hot = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k")
    dim = spark.range(50).selectExpr("id AS k")
    p = plan(measures.cross_filter_dim(dim, "k", hot, "k"))
    assert "HashAggregate" in p and "LeftSemi" in p
    p = plan(queue.fetch_queue(dim, hot, hot, [("k", "k")]))
    assert p.count("HashAggregate") >= 4 and "LeftAnti" in p


def test_distinct_count_is_two_level_aggregate(spark):
    from marquee.operators import marts
    p = plan(marts.dim_distributor(S.stg(spark, SF)))
    assert "count(distinct" in p.lower()
    assert "Window" not in p


def test_bucketed_star_joins_without_shuffle(spark):
    import uuid

    from marquee.operators import marts, measures
    from marquee.plans.build import star
    from marquee.session import scratch_path
    s = star(spark, SF)
    prefix = f"b{uuid.uuid4().hex[:6]}_"
    t = marts.publish(spark, {}, {"fact_daily_revenue": s["fact_daily_revenue"], "dim_movie": s["dim_movie"]},
                      scratch_path(spark, "bucketed"), prefix, buckets=marts.STAR_BUCKETS, num_buckets=8)
    report = measures.revenue_by_director(t["fact_daily_revenue"], t["dim_movie"])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        report.explain()
    p = buf.getvalue()
    # the per-movie aggregate runs on the bucketed scan: no shuffle on the movie key
    assert "Bucketed: true" in p
    assert "hashpartitioning(movie_key" not in p and "hashpartitioning(imdb_id" not in p
    got = sorted((tuple(r) for r in report.collect()), key=str)
    want = sorted((tuple(r) for r in measures.revenue_by_director(
        s["fact_daily_revenue"], s["dim_movie"]).collect()), key=str)
    assert got == want
