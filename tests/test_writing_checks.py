"""Checks while writing, fused key checks, mergeable distinct counts, footers, streamed quota, quoted line feeds."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import measures, quality
from marquee.session import child_files, scratch_path
from marquee.sources import csv_drops, json_docs
from marquee.streaming import ingest


def test_rows_are_checked_while_they_are_written(spark):
    df = spark.createDataFrame([("a", 1), ("b", -1), (None, -2), ("d", None)], "id string, n int")
    good, bad, summary = quality.write_checked(df, scratch_path(spark, "t-checked"), {
        "not_null_id": F.col("id").isNull(), "positive_n": F.col("n") < 0, "never": F.lit(False)})
    assert sorted(map(str, good.collect())) == sorted(map(str, df.where("id IN ('a', 'd')").collect()))
    assert {r["id"]: r["_failed"] for r in bad.collect()} == {"b": ["positive_n"], None: ["not_null_id", "positive_n"]}
    assert [tuple(r) for r in summary.collect()] == [("not_null_id", 1, "fail"), ("positive_n", 2, "fail"), ("never", 0, "pass")]
    with pytest.raises(RuntimeError, match="positive_n=2"):
        quality.gate(summary)
    good, bad, summary = quality.write_checked(df.limit(0), scratch_path(spark, "t-checked"), {"x": F.col("n") < 0})
    assert good.collect() == bad.collect() == [] and summary.first().status == "pass"


def test_key_checks_in_one_scan_of_each_table(spark):
    path = scratch_path(spark, "t-keys")
    spark.createDataFrame([("m1",), ("m2",), ("m2",), (None,)], "id string").write.parquet(f"{path}/dim")
    spark.createDataFrame([(1, "m1"), (1, "m2"), (2, "gone"), (3, "gone"), (4, None)], "row long, movie string").write.parquet(f"{path}/fact")
    dim, fact = spark.read.parquet(f"{path}/dim"), spark.read.parquet(f"{path}/fact")
    checks = quality.key_checks({"unique_dim": ("movie", dim, "id"), "unique_fact": ("row", fact, "row")},
                                {"fact_movie": ("movie", fact, "movie")})
    plan = checks._jdf.queryExecution().toString()
    assert sorted(map(tuple, checks.collect())) == [("fact_movie", 2, "fail"), ("unique_dim", 1, "fail"), ("unique_fact", 1, "fail")]
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("FileScan parquet") == 2
    none = quality.key_checks({"unique_dim": ("movie", dim.limit(0), "id")}, {"fact_movie": ("movie", fact.limit(0), "movie")})
    assert {r.status for r in none.collect()} == {"pass"}


def test_united_sketches_stay_within_their_bound(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 30).cast("int").alias("date_key"), (F.col("id") % 7).cast("string").alias("distributor_key"),
        (F.col("id") % 20_011).cast("string").alias("movie_key"), F.lit(1).cast("decimal(12,0)").alias("revenue"))
    kept = measures.film_sketches(rows)
    assert kept.count() == 210
    for keep, by in ((F.lit(True), ()), (F.col("date_key") < 3, ()), (F.col("date_key") >= 10, ("distributor_key",))):
        exact = {tuple(r[:-2]): (r["n"], r["s"]) for r in rows.where(keep).groupBy(*by).agg(
            F.count_distinct("movie_key").alias("n"), F.count(F.lit(1)).alias("s")).collect()}
        for r in measures.estimated_films(kept.where(keep), *by).collect():
            n, s = exact[tuple(r[c] for c in by)]
            assert abs(r["films_estimate"] - n) <= 3 * 1.04 / 64 * n + 1 and r["n_rows"] == s


def test_bounds_come_from_footers(spark):
    path = scratch_path(spark, "t-footers")
    df = spark.range(1000).select("id", F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"),
                                  F.col("id").cast("string").alias("name"))
    df.repartition(4).write.parquet(path)
    plan = []
    got = {r["column"]: (r["lo"], r["hi"], r["n_rows"]) for r in measures.footer_bounds(spark, path, "id", "day", plan=plan).collect()}
    assert got == {"id": ("0", "999", 1000), "day": ("2020-01-01", "2022-09-26", 1000)}
    assert "PushedAggregation: [MIN(id), MAX(id), MIN(day), MAX(day), COUNT" in plan[0]
    with pytest.raises(TypeError):
        measures.footer_bounds(spark, path, "name")
    assert "FileScan" in spark.read.parquet(path)._jdf.queryExecution().toString()  # the settings are as before


def test_quota_counts_late_calls_into_their_day(spark):
    root = scratch_path(spark, "t-quota")
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    files = [[at(10, 1), at(10, 2), at(11, 3)], [at(9, 5), at(11, 4), at(12, 1)], [at(10, 23), at(8, 0), at(12, 2)]]
    table, want = ingest.day_calls(spark, f"{root}/days"), {}
    for k, calls in enumerate(files):  # a restart for each file
        log = spark.createDataFrame([(10 * k + i, c, i, "found", 200, None) for i, c in enumerate(calls)], json_docs.LOG_ROW_DDL)
        json_docs.pack_log_batches(log).select("batch").coalesce(1).write.text(f"{root}/inbox/{k}")
        assert ingest.count_calls(spark, f"{root}/inbox", table, f"{root}/ck", suffix=".txt") >= 1
        for c in calls:
            want[c.date()] = want.get(c.date(), 0) + 1
        assert {r.day: r.n_calls for r in table.read().collect()} == want
    ingest.count_calls(spark, f"{root}/inbox", table, f"{root}/ck", suffix=".txt")
    assert {r.day: r.n_calls for r in table.read().collect()} == want


def test_quoted_line_feeds_over_many_splits(spark):
    rng = random.Random(6)
    pieces = ["plain", "a,b", 'say "hi"', "two\nlines", "\n", "end\r\nmore", '"', '""\n""', " lead", "é\n漢", "x" * 300 + "\n" + "y" * 300]
    rows = [(str(i), "2003-01-01", rng.choice(pieces) + rng.choice(pieces) + "!", str(i % 50), "1", rng.choice(pieces) + "?")
            for i in range(400)]
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in '",\n\r') or v.startswith(" ") else v
    root = scratch_path(spark, "t-quoted")
    for k, end in enumerate(("\n", "\r\n")):
        body = "id,revenue_date,title,revenue,theaters,distributor" + end + "".join(
            ",".join(map(quoted, r)) + end for r in rows[k * 200:(k + 1) * 200])
        path = f"{root}/{k}.csv".removeprefix("file:")
        import os
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8", newline="") as f:
            f.write(body)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    for size in ("700", "10000", before):
        spark.conf.set(key, size)
        try:
            got = csv_drops.read_quoted(spark, root).collect()
            splits = spark.read.text(root).rdd.getNumPartitions() if size != before else 1
        finally:
            spark.conf.set(key, before)
        assert sorted((r.id, str(r.revenue_date), r.title, str(r.revenue), r.distributor) for r in got) == sorted(
            (r[0], r[1], r[2], r[3], r[5]) for r in rows)
        assert {r._source_file.rsplit("/", 1)[-1] for r in got} == {"0.csv", "1.csv"}
        assert splits > 20 or size != "700"
