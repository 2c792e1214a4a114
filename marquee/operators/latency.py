"""Per-step latency profile with exact order statistics.

For each step: n, mean, p50 = s[n div 2], p95 = s[min(floor(0.95 n), n-1)]
(0-based positions in the sorted samples), max, total and the step's share
of the api+s3+log total (the 'total' step shows 100).

Exact positions without sorting a whole step in one task
----------------------------------------------------------
A step can hold a third of all samples, so a window ``partitionBy(step)
.orderBy(value)`` would sort that third in a single task.  Instead:

1. one aggregate per step gives n, sum, max and ``percentile_approx`` at the
   target quantile ± a margin.  The sketch's rank error is at most
   n / accuracy, so the true k-th value lies between the two bracket values.
2. an exact count of samples below the lower bracket (a partial aggregate)
   gives the rank offset of the bracket.
3. samples inside the bracket are counted by value (with map-side combine, so
   a value that a third of the samples share is one row), the counts are
   cumulated over the bracket's distinct values, and the value whose run
   holds position k - offset is picked.

Steps' statistics have one row per listed step and are broadcast (bounded
by the length of the step list, not by the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The steps whose totals form the share denominator, the step
# reported with 100 %, and the output order.
SHARE_STEPS = ("api", "s3", "log")
TOTAL_STEP = "total"
STEP_ORDER = ("api", "s3", "log", "total")

ACCURACY = 100_000


def _targets():
    n = F.col("n")
    k50 = F.floor(n / 2).cast("long")
    k95 = F.least(F.floor(n * F.lit(0.95)).cast("long"), n - 1)
    return k50, k95


def step_profile(samples: DataFrame, step: str = "step", value: str = "value",
                 accuracy: int = ACCURACY, steps=STEP_ORDER) -> DataFrame:
    """Profile of the listed ``steps`` (the profile reports exactly these).

    Restricting to a known list also bounds the per-step statistics that are
    broadcast: at most ``len(steps)`` rows.
    """
    margin = 4.0 / accuracy
    s = (samples.select(F.col(step).alias("step"), F.col(value).cast("double").alias("value"))
         .where(F.col("step").isin(*steps)))
    qs = [max(0.0, 0.5 - margin), min(1.0, 0.5 + margin),
          max(0.0, 0.95 - margin), min(1.0, 0.95 + margin)]
    stats = s.groupBy("step").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max("value").alias("mx"),
        F.percentile_approx("value", qs, accuracy).alias("q"))
    k50, k95 = _targets()
    stats = stats.select("step", "n", "total", "mx",
                         F.col("q")[0].alias("lo50"), F.col("q")[1].alias("hi50"),
                         F.col("q")[2].alias("lo95"), F.col("q")[3].alias("hi95"),
                         k50.alias("k50"), k95.alias("k95"))

    j = s.join(F.broadcast(stats), "step")
    below = j.groupBy("step").agg(
        F.sum(F.when(F.col("value") < F.col("lo50"), 1).otherwise(0)).cast("long").alias("b50"),
        F.sum(F.when(F.col("value") < F.col("lo95"), 1).otherwise(0)).cast("long").alias("b95"))

    sliced = j.select("step", "value", F.explode(F.array(
        F.when(F.col("value").between(F.col("lo50"), F.col("hi50")), F.lit("p50")),
        F.when(F.col("value").between(F.col("lo95"), F.col("hi95")), F.lit("p95")))).alias("which")
    ).where(F.col("which").isNotNull())
    counted = sliced.groupBy("step", "which", "value").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("step", "which").orderBy("value"))
    ranked = counted.withColumn("end", upto).withColumn("begin", F.col("end") - F.col("c"))

    def holds(k: str, b: str):
        at = F.col(k) - F.col(b)
        return (F.col("begin") <= at) & (at < F.col("end"))

    picked = (ranked.join(F.broadcast(below.join(stats.select("step", "k50", "k95"), "step")), "step")
              .where(((F.col("which") == "p50") & holds("k50", "b50"))
                     | ((F.col("which") == "p95") & holds("k95", "b95")))
              .groupBy("step")
              .agg(F.max(F.when(F.col("which") == "p50", F.col("value"))).alias("p50"),
                   F.max(F.when(F.col("which") == "p95", F.col("value"))).alias("p95")))

    out = _with_share(stats.join(picked, "step", "left"))

    def exact(c: str):
        # The sketch's error bound makes a miss impossible; if it ever
        # happened the job fails instead of returning a wrong statistic.
        missed = F.col(c).isNull() & (F.col("n") > 0)
        return F.when(missed, F.raise_error(F.lit(f"{c}: percentile bracket missed; raise accuracy"))
                      .cast("double")).otherwise(F.col(c) * 1000)

    return out.select(
        "step", "n",
        F.round(F.col("total") / F.col("n") * 1000, 3).alias("mean_ms"),
        exact("p50").alias("p50_ms"),
        exact("p95").alias("p95_ms"),
        (F.col("mx") * 1000).alias("max_ms"),
        F.round("total", 6).alias("total_s"),
        "pct",
    )


def _with_share(stats: DataFrame) -> DataFrame:
    """Attach each step's share of the api+s3+log total.

    ``stats`` has one row per step (a handful of rows), so the window over
    all of its rows is the cheap way to get the denominator - no join.
    """
    every = Window.partitionBy(F.lit(0))
    denom = F.sum(F.when(F.col("step").isin(*SHARE_STEPS), F.col("total"))).over(every)
    pct = (F.when(F.col("step") == TOTAL_STEP, F.lit(100.0))
           .when(denom > 0, F.round(F.col("total") / denom * 100, 3))
           .otherwise(F.lit(0.0)))
    return stats.withColumn("pct", pct)
