"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits a skewed sort-merge join only when both join inputs come straight
from a shuffle; when one side is an aggregate keyed like the join (for
example "per-title minimum joined back on title") the aggregate already
satisfies the join's partitioning, the pattern does not match, and every
row of a hot title would meet in one task.  ``salted_join`` handles that
case explicitly:

1. ``hot_keys``: from a per-key row count, the keys with more rows than an
   average shuffle partition (n > N / P).  Fewer than P keys can qualify,
   so the hot list has a proven bound of P rows and is broadcast.  Each hot
   key gets ``ceil(n / (N / P))`` salt buckets (capped at P): a key holding
   a third of the rows spreads over a third of the partitions.
2. big side: hot rows get a deterministic salt ``pmod(xxhash64(cols), b)``
   (a retried task computes the same salt), other rows salt 0.
3. small side: rows of hot keys are repeated once per bucket
   (at most P + #hot extra rows), others once with salt 0.
4. equi-join on (keys, salt).

The total N is a scalar subquery (``DataFrame.scalar()``), not a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, keys: Sequence[str], n_col: str = "n",
             partitions: int | None = None) -> DataFrame:
    """Keys above one average partition of rows, with their bucket counts."""
    p = partitions or shuffle_partitions(counts)
    per_partition = counts.agg(F.sum(n_col)).scalar() / F.lit(p)
    buckets = F.least(F.lit(p), F.ceil(F.col(n_col) / per_partition)).cast("int")
    return (counts.where(F.col(n_col) > per_partition)
            .select(*keys, buckets.alias("_buckets")))


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], hot: DataFrame,
                salt_cols: Sequence[str], how: str = "inner") -> DataFrame:
    """``big.join(small, keys, how)`` with hot keys of ``big`` spread over buckets.

    ``small`` must have at most one row per key (a dimension / aggregate);
    ``hot`` comes from ``hot_keys``.  Same rows as the plain join.
    """
    keys = list(keys)
    flags = F.broadcast(hot.select(*keys, "_buckets"))  # bounded by the partition count
    b = big.join(flags, keys, "left")
    b = b.withColumn("_salt", F.when(F.col("_buckets").isNotNull(),
                                     F.pmod(F.xxhash64(*salt_cols), F.col("_buckets")))
                     .otherwise(F.lit(0).cast("long"))).drop("_buckets")
    s = small.join(flags, keys, "left")
    s = s.withColumn("_salt", F.explode(
        F.when(F.col("_buckets").isNotNull(),
               F.sequence(F.lit(0).cast("long"), (F.col("_buckets") - 1).cast("long")))
        .otherwise(F.array(F.lit(0).cast("long"))))).drop("_buckets")
    return b.join(s, [*keys, "_salt"], how).drop("_salt")


def join_back(big: DataFrame, per_key: DataFrame, keys: Sequence[str], salt_cols: Sequence[str],
              how: str = "left") -> DataFrame:
    """Join a per-key aggregate back onto the rows it was computed from.

    The per-key row counts of ``big`` (one more partial aggregate) pick the
    hot keys; those are salted, the rest join as usual.
    """
    keys = list(keys)
    counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return salted_join(big, per_key, keys, hot_keys(counts, keys, "_n"), salt_cols, how)
