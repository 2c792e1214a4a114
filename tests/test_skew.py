"""A hot key holding most rows: the join is split; results stay whole."""
import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from marquee.operators import marts, skew, staging

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
RAW = ("id string, revenue_date date, title string, revenue string, theaters string, "
       "distributor string, _loaded_at timestamp_ntz")


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


class conf:
    def __init__(self, spark, values):
        self.spark, self.values = spark, values

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.values}
        for k, v in self.values.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def _raw(spark):
    hot = [(str(i), dt.date(2003 + i % 3, 1, 1), "HOT", str(i), "1", "BIG", dt.datetime(2024, 1, 1))
           for i in range(6000)]
    cold = [(f"c{i}", dt.date(2004, 1, 1), f"T{i}", "1", "1", f"D{i % 7}", dt.datetime(2024, 1, 1))
            for i in range(300)]
    return spark.createDataFrame(hot + cold, RAW).repartition(8)


def test_hot_keys_bound(spark):
    counts = spark.createDataFrame([("a", 900), ("b", 50), ("c", 50)], "k string, n long")
    hot = {r.k: r._buckets for r in skew.hot_keys(counts, ["k"], partitions=10).collect()}
    assert hot == {"a": 9}


def test_salted_join_equals_plain_join(spark):
    big = spark.createDataFrame([(i, "a" if i < 900 else f"k{i % 5}") for i in range(1000)] + [(2000, None)],
                                "id long, k string")
    small = spark.createDataFrame([("a", 1), ("k0", 2), ("k1", 3), (None, 9)], "k string, v int")
    counts = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = skew.hot_keys(counts, ["k"], partitions=10)
    for how in ("inner", "left"):
        got = sorted(tuple(r) for r in skew.salted_join(big, small, ["k"], hot, ["id"], how)
                     .select("id", "k", "v").collect())
        want = sorted(tuple(r) for r in big.join(small, ["k"], how).select("id", "k", "v").collect())
        assert got == want


def test_hot_title_is_salted(spark):
    with conf(spark, SKEW_CONF):
        stg = staging.stg_revenues(_raw(spark))
        p = final_plan(stg)
        assert "_salt" in p and "xxhash64" in p
        got = stg.groupBy("title").agg(F.count(F.lit(1)).alias("n"), F.min("release_year").alias("y"))
        res = {r.title: (r.n, r.y) for r in got.collect()}
        assert res["HOT"] == (6000, 2003) and len(res) == 301
        assert stg.where("title = 'HOT'").agg(F.countDistinct("release_year")).first()[0] == 1


def test_fact_join_on_hot_distributor_is_split_by_aqe(spark):
    with conf(spark, SKEW_CONF):
        stg = staging.stg_revenues(_raw(spark))
        dists = marts.dim_distributor(stg)
        movies = stg.select(F.col("title").alias("lookup_title"), "release_year").distinct() \
            .withColumn("imdb_id", F.concat(F.lit("tt_"), F.col("lookup_title")))
        fact = marts.fact_daily_revenue(stg, movies, dists)
        p = final_plan(fact)
        assert "skew=true" in p
        assert fact.count() == 6300
