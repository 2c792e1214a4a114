"""Data-quality checks as DataFrames.

Each check returns the *failing rows* (zero rows = pass), exactly like a
test query; ``summary`` turns a set of checks into one row per check
(name, failures, status) with a single union, and ``gate`` raises when a
check failed, stopping the downstream build.

NULL rules: ``unique`` ignores NULL keys; ``unique_combination`` groups
NULLs together; ``accepted_range`` and ``expression_is_true`` let NULL pass;
``relationships`` ignores NULL child keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASS, WARN, FAIL, ERROR = "pass", "warn", "fail", "error"


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Key values occurring more than once (NULL keys ignored)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Combinations occurring more than once (NULLs compare equal)."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


def accepted_range(df: DataFrame, col: str, lo=None, hi=None, inclusive: bool = True) -> DataFrame:
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | ((c < lo) if inclusive else (c <= lo))
    if hi is not None:
        bad = bad | ((c > hi) if inclusive else (c >= hi))
    return df.where(bad)  # NULL compares to NULL -> row not returned


def expression_is_true(df: DataFrame, expr: Column | str) -> DataFrame:
    e = F.expr(expr) if isinstance(expr, str) else expr
    return df.where(~e)  # NOT NULL is NULL -> row not returned


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (anti join)."""
    p = parent.select(F.col(field).alias("_parent_key")).where(F.col("_parent_key").isNotNull())
    return (child.where(F.col(col).isNotNull())
            .join(p, F.col(col) == F.col("_parent_key"), "left_anti"))


def future_dates(df: DataFrame, col: str, as_of: str) -> DataFrame:
    return df.where(F.col(col) > F.to_date(F.lit(as_of)))


def failures(check: DataFrame, name: str, severity: str = ERROR) -> DataFrame:
    """One row (check, failures, status) for a failing-rows frame."""
    n = F.count(F.lit(1))
    return check.agg(F.lit(name).alias("check_name"), n.alias("failures"),
                     F.when(n == 0, F.lit(PASS))
                     .otherwise(F.lit(FAIL if severity == ERROR else WARN)).alias("status"))


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in checks.items():
        one = failures(df, name)
        out = one if out is None else out.unionByName(one)
    return out


def row_check_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Failure counts of many row-level checks on one table in ONE scan.

    ``conditions`` maps check name -> a predicate that is true for a failing
    row (NULL counts as passing).  The counts come from one aggregate and
    are unpivoted into (check_name, failures, status) rows.
    """
    names = list(conditions)
    counts = df.agg(*[F.sum(F.when(c, 1).otherwise(0)).cast("long").alias(f"_c{i}")
                      for i, c in enumerate(conditions.values())])
    rows = counts.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.coalesce(F.col(f"_c{i}"), F.lit(0)).alias("failures"))
        for i, n in enumerate(names)])).alias("r")).select("r.*")
    return rows.withColumn("status", F.when(F.col("failures") == 0, F.lit(PASS)).otherwise(F.lit(FAIL)))


def star_summary(marts: dict[str, DataFrame], stg: DataFrame, as_of: str) -> DataFrame:
    """Same rows as ``summary(star_checks(...))`` with one scan per table for row checks.

    Row-level checks (not_null, accepted_range, expression_is_true, future
    dates) of a table share one aggregate; key checks (unique, combination,
    relationships) keep their own aggregate / anti join.
    """
    m, d, dist, f = (marts["dim_movie"], marts["dim_date"], marts["dim_distributor"],
                     marts["fact_daily_revenue"])
    c = F.col
    parts = [
        row_check_counts(m, {
            "not_null_dim_movie_imdb_id": c("imdb_id").isNull(),
            "accepted_range_dim_movie_imdb_rating": (c("imdb_rating") < 1.0) | (c("imdb_rating") > 10.0)}),
        row_check_counts(d, {"not_null_dim_date_date_key": c("date_key").isNull()}),
        row_check_counts(dist, {"not_null_dim_distributor_distributor_key": c("distributor_key").isNull()}),
        row_check_counts(f, {
            "not_null_fact_source_row_id": c("source_row_id").isNull(),
            "not_null_fact_movie_key": c("movie_key").isNull(),
            "not_null_fact_date_key": c("date_key").isNull(),
            "not_null_fact_distributor_key": c("distributor_key").isNull(),
            "expression_is_true_fact_revenue": ~(c("revenue") >= 0),
            "no_future_revenue_dates": c("revenue_date") > F.to_date(F.lit(as_of))}),
        summary({
            "unique_dim_movie_imdb_id": unique(m, "imdb_id"),
            "unique_dim_date_date_key": unique(d, "date_key"),
            "unique_dim_distributor_distributor_key": unique(dist, "distributor_key"),
            "unique_fact_source_row_id": unique(f, "source_row_id"),
            "relationships_fact_movie_key": relationships(f, "movie_key", m, "imdb_id"),
            "relationships_fact_date_key": relationships(f, "date_key", d, "date_key"),
            "relationships_fact_distributor_key": relationships(f, "distributor_key", dist,
                                                                "distributor_key"),
            "unique_combination_stg_revenues": unique_combination(
                stg, ["revenue_date", "title", "distributor"]),
        }),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def staging_summary(stg: DataFrame) -> DataFrame:
    """Checks of the staged rows alone; they gate the marts."""
    return (row_check_counts(stg, {
        "not_null_stg_revenues_id": F.col("id").isNull(),
        "not_null_stg_revenues_revenue_date": F.col("revenue_date").isNull(),
        "not_null_stg_revenues_title": F.col("title").isNull(),
        "not_negative_stg_revenues_revenue": F.col("revenue") < 0})
        .unionByName(summary({
            "unique_stg_revenues_id": unique(stg, "id"),
            "unique_combination_stg_revenues": unique_combination(stg, ["revenue_date", "title", "distributor"])})))


def gate(summary_df: DataFrame) -> DataFrame:
    """Raise if any check failed; otherwise return the summary unchanged.

    Only the failing rows (at most one per check) reach the driver.
    """
    failed = summary_df.where(F.col("status") == FAIL).select("check_name", "failures").collect()
    if failed:
        detail = ", ".join(f"{r.check_name}={r.failures}" for r in failed)
        raise RuntimeError(f"data checks failed: {detail}")
    return summary_df


def star_checks(marts: dict[str, DataFrame], stg: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The schema tests of the star plus the staged-grain and future-date tests."""
    m, d, dist, f = (marts["dim_movie"], marts["dim_date"], marts["dim_distributor"],
                     marts["fact_daily_revenue"])
    return {
        "not_null_dim_movie_imdb_id": not_null(m, "imdb_id"),
        "unique_dim_movie_imdb_id": unique(m, "imdb_id"),
        "accepted_range_dim_movie_imdb_rating": accepted_range(m, "imdb_rating", 1.0, 10.0),
        "not_null_dim_date_date_key": not_null(d, "date_key"),
        "unique_dim_date_date_key": unique(d, "date_key"),
        "not_null_dim_distributor_distributor_key": not_null(dist, "distributor_key"),
        "unique_dim_distributor_distributor_key": unique(dist, "distributor_key"),
        "not_null_fact_source_row_id": not_null(f, "source_row_id"),
        "unique_fact_source_row_id": unique(f, "source_row_id"),
        "not_null_fact_movie_key": not_null(f, "movie_key"),
        "relationships_fact_movie_key": relationships(f, "movie_key", m, "imdb_id"),
        "not_null_fact_date_key": not_null(f, "date_key"),
        "relationships_fact_date_key": relationships(f, "date_key", d, "date_key"),
        "not_null_fact_distributor_key": not_null(f, "distributor_key"),
        "relationships_fact_distributor_key": relationships(f, "distributor_key", dist,
                                                            "distributor_key"),
        "expression_is_true_fact_revenue": expression_is_true(f, F.col("revenue") >= 0),
        "unique_combination_stg_revenues": unique_combination(
            stg, ["revenue_date", "title", "distributor"]),
        "no_future_revenue_dates": future_dates(f, "revenue_date", as_of),
    }


# --- checks while writing ------------------------------------------------------------

def write_checked(df: DataFrame, path: str, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write ``df`` to ``path`` and check its rows in the same job: (good rows, quarantined rows, summary).

    ``rules`` maps check name -> a predicate that is true for a failing row
    (NULL counts as passing).  The counts are observed by the write itself, so
    nothing is read again; failing rows are quarantined in a partition of
    their own, with the names of the checks that they failed (``_failed``).
    """
    spark, seen = df.sparkSession, Observation("checks")
    hits = [F.coalesce(c, F.lit(False)) for c in rules.values()]
    failed = F.array_compact(F.array(*[F.when(h, F.lit(n)) for n, h in zip(rules, hits)])).cast("array<string>")
    flagged = df.observe(seen, F.count(F.lit(1)).alias("rows"),
                         *[F.count_if(h).alias(f"c{i}") for i, h in enumerate(hits)])
    (flagged.withColumn("_failed", failed).withColumn("_bad", F.size("_failed") > 0)
            .write.partitionBy("_bad").parquet(path))
    marks = [T.StructField("_failed", T.ArrayType(T.StringType())), T.StructField("_bad", T.BooleanType())]
    written = spark.read.schema(T.StructType([*df.schema.fields, *marks])).parquet(path)
    counts = seen.get
    summary_rows = [(n, int(counts[f"c{i}"]), PASS if not counts[f"c{i}"] else FAIL) for i, n in enumerate(rules)]
    out = spark.createDataFrame(summary_rows, "check_name string, failures bigint, status string")
    return (written.where("NOT _bad").drop("_failed", "_bad"), written.where("_bad").drop("_bad"), out)


def key_checks(unique_keys: dict[str, tuple[str, DataFrame, str]],
               references: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """Unique and referential checks of many tables: one scan of each table, one shuffle, one row per check.

    ``unique_keys`` maps check name -> (key space, table, column): the column
    holds each key of its space once.  ``references`` maps check name -> (key
    space, table, column): the column's keys must be in the space.  All keys of
    a table come from one scan (give the same DataFrame for its checks), are
    counted by space and key with map-side combine, and a count of owners and
    of references decides both kinds.  NULL keys are ignored.
    """
    names = [*unique_keys, *references]
    by_table: dict[int, tuple[DataFrame, list]] = {}
    for i, name in enumerate(names):
        owner = name in unique_keys
        space, table, column = (unique_keys if owner else references)[name]
        key = F.struct(F.lit(space).alias("space"), F.col(column).cast("string").alias("key"),
                       F.lit(i if not owner else -1).alias("ref"))
        by_table.setdefault(id(table), (table, []))[1].append(key)
    rows = None
    for table, keys in by_table.values():
        one = table.select(F.inline(F.array(*keys)))
        rows = one if rows is None else rows.unionByName(one)
    refs = range(len(unique_keys), len(names))
    counted = rows.where("key IS NOT NULL").groupBy("space", "key").agg(
        F.count_if(F.col("ref") == -1).alias("owners"), *[F.count_if(F.col("ref") == i).alias(f"r{i}") for i in refs])
    checks = [F.count_if((F.col("space") == unique_keys[n][0]) & (F.col("owners") > 1)).alias(f"c{i}")
              for i, n in enumerate(unique_keys)]
    checks += [F.coalesce(F.sum(F.when((F.col("space") == references[names[i]][0]) & (F.col("owners") == 0), F.col(f"r{i}"))),
                          F.lit(0)).cast("long").alias(f"c{i}") for i in refs]
    out = counted.agg(*checks).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("failures")) for i, n in enumerate(names)])))
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit(PASS)).otherwise(F.lit(FAIL)))


# Freshness thresholds in hours (warn, error) per source.
FRESHNESS_HOURS = {"raw.revenues": (36, 72), "raw.omdb": (7 * 24, 14 * 24)}


def freshness(source: str, df: DataFrame, loaded_at: str, as_of_ts: str,
              warn_hours: float | None = None, error_hours: float | None = None) -> DataFrame:
    """One row: source, newest load, age in hours at ``as_of_ts``, pass/warn/error (error if empty)."""
    w, e = FRESHNESS_HOURS.get(source, (warn_hours, error_hours))
    w = warn_hours if warn_hours is not None else w
    e = error_hours if error_hours is not None else e
    as_of = F.to_timestamp_ntz(F.lit(as_of_ts))
    newest = F.max(loaded_at)
    age = F.timestamp_diff("MICROSECOND", newest, as_of) / F.lit(3_600_000_000.0)
    return df.agg(F.lit(source).alias("source"), newest.alias("max_loaded_at"),
                  F.round(age, 6).alias("age_hours")).select(
        "source", "max_loaded_at", "age_hours",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > e), F.lit(ERROR))
         .when(F.col("age_hours") > w, F.lit(WARN))
         .otherwise(F.lit(PASS)).alias("status"))


__all__ = ["not_null", "unique", "unique_combination", "accepted_range", "expression_is_true",
           "relationships", "future_dates", "failures", "summary", "gate", "star_checks",
           "row_check_counts", "star_summary", "freshness", "write_checked", "key_checks"]
