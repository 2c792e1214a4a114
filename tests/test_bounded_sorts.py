"""Sorts of the star build come after a shuffle, so a task sorts a partition and not a whole input split."""
import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import marts, staging
from marquee.session import scratch_path
from marquee.sources.keyed_table import KeyedTable


def newest(rows):
    out = {}
    for k, t, v in rows:
        out[k] = max(out.get(k, (t, v)), (t, v))
    return sorted((str(k), *r) for k, r in out.items())


@pytest.mark.parametrize("full", [5, 1 << 18])
def test_latest_rows_with_and_without_full_keys(spark, monkeypatch, full):
    monkeypatch.setattr(staging, "FULL_ROWS", full)
    rng = random.Random(full)
    rows = [(rng.choice(["hot"] * 20 + [None, *map(str, range(40))]), rng.randrange(9), f"v{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    hot = staging.full_slots(df, F.pmod(F.xxhash64("k"), F.lit(staging.KEY_SLOTS)))
    assert bool(hot) == (full == 5)
    got = staging.dedupe_latest(df, "k", ["t", "v"])
    assert sorted((str(r.k), r.t, r.v) for r in got.collect()) == newest(rows)


def test_latest_rows_are_sorted_after_their_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 9).cast("string").alias("k"), F.col("id").cast("string").alias("v"))
    plan = staging.dedupe_latest(df, "k", ["v"])._jdf.queryExecution().sparkPlan().toString()
    # From the last step to the first: both halves of the aggregate, then the shuffle that they share.
    assert plan.rindex("SortAggregate") < plan.index("Exchange")
    assert plan.count("Exchange") == 1


def test_a_month_of_the_fact_is_in_one_file(spark):
    rows = spark.range(0, 600, 1, 4).select(
        F.date_add(F.lit("2020-01-15").cast("date"), ((F.col("id") * 7) % 372).cast("int")).alias("revenue_date"), "id")
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = marts.materialize(spark, {"fact_daily_revenue": rows}, scratch_path(spark, "t-months"))["fact_daily_revenue"]
        found = out.select(F.trunc("revenue_date", "month").alias("m"), F.input_file_name().alias("f")).distinct().collect()
        assert len(found) == len({r.m for r in found}) == 13
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    assert out.columns == ["revenue_date", "id"] and out.count() == 600


def test_rows_of_some_titles_are_replaced_without_a_comparison(spark):
    schema = "title string, id int, v int"
    table = KeyedTable(spark, scratch_path(spark, "t-instead"), schema, ["title", "id"], ["v"],
                       F.pmod(F.xxhash64("title"), F.lit(4)))
    table.merge(spark.createDataFrame([("a", 1, 9), ("a", 2, 9), ("b", 1, 9), (None, 1, 9), ("c", 1, 9)], schema))
    titles = spark.createDataFrame([("a",), (None,), ("c",)], "title string")
    new = spark.createDataFrame([("a", 2, 1), ("a", 3, 1), (None, 5, 1)], schema)
    table.merge(new, ("s", 0), instead_of=(titles, "title"))
    want = [("None", 5, 1), ("a", 2, 1), ("a", 3, 1), ("b", 1, 9)]
    assert sorted((str(r.title), r.id, r.v) for r in table.read().collect()) == want
    assert table.merge(new, ("s", 0), instead_of=(titles, "title"))["rewritten"] == []  # applied once
    assert sorted((str(r.title), r.id, r.v) for r in table.read().collect()) == want
