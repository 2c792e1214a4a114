"""JSON document cache and the call log.

* sink: one JSON object per document, partitioned by fetch day
  (``yyyy=/mm=/dd=``) so readers prune by day;
* scan: documents read in place as a single VARIANT column; the day
  columns come back from the folder names;
* refresh: ``frozen_docs.FrozenDocuments`` reads the files registered at its last
  refresh; a plain reader lists anew each time it is built, and
  ``refresh_cache`` invalidates a cached listing of a path;
* call log: rows are shipped as JSON arrays of bounded size (50 rows) and
  unpacked again with ``from_json`` + ``inline``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import json as J
from ..session import below, child_files, move_to, path_exists, scratch_path

# Rows per log batch, and the log row layout.
LOG_BATCH_ROWS = 50
LOG_ROW_DDL = ("event_id bigint, call_at timestamp_ntz, lookup_key bigint, outcome string, "
               "http_status int, error_message string")
# The pipeline's own call log.
DAY_COLUMNS = ("yyyy", "mm", "dd")
# Where files that a keyed write has replaced lie until the listing is refreshed (hidden from scans).
SUPERSEDED = "_superseded"
CALL_ROW_DDL = ("lookup_title string, lookup_year int, outcome string, http_status int, "
                "error_message string")


def day_partitions(ts: str) -> list:
    return [F.date_format(ts, "yyyy").alias("yyyy"), F.date_format(ts, "MM").alias("mm"),
            F.date_format(ts, "dd").alias("dd")]


def write_documents(docs: DataFrame, path: str, json_col: str = "doc_json",
                    fetched_at: str = "fetched_at", key: str | None = None) -> None:
    """Write documents as JSON lines below ``path/yyyy=/mm=/dd=``.

    Rows are rebalanced by day before the write: small days become one file
    each, and a day larger than the advisory partition size is split over as
    many tasks as its bytes ask for.

    With ``key`` (a column that names the record) a day holds one document per
    record, the latest: the touched days are merged with what they hold (the
    key is stored in the line's ``_record`` field) and written anew as a whole,
    so a repeated run leaves the cache as it was; the files replaced move below
    ``_superseded``, for readers of a frozen listing.  Without it, rows are
    appended.
    """
    spark = docs.sparkSession
    days = ("yyyy", "mm", "dd")
    if key is None:
        (docs.select(F.col(json_col).alias("value"), *day_partitions(fetched_at))
             .hint("rebalance", *days).write.mode("append").partitionBy(*days).text(path))
        return
    tagged = J.merge_objects(F.col(json_col), F.to_json(F.struct(F.col(key).alias("_record"))))
    new = docs.select(F.col(key).alias("record"), tagged.alias("value"), F.col(fetched_at).alias("at"),
                      F.lit(1).alias("run"), *day_partitions(fetched_at))
    rows = new
    held, replaced = spark.read.text(path) if path_exists(spark, path) else new, []
    if held.columns == ["value", *days]:  # else there is nothing yet
        # The days of one run, as literals: only their folders are listed and read.
        touched = new.select(*days).distinct().collect()
        old = _days_as_text(held.where(days_touched(touched)))
        replaced = [f for y, m, d in touched for f in child_files(spark, f"{path}/yyyy={y}/mm={m}/dd={d}")]
        v = J.parse("value")
        rows = new.unionByName(old.select(
            J.vget(v, "$._record").alias("record"), "value", F.lit(None).cast(new.schema["at"].dataType).alias("at"),
            F.lit(0).alias("run"), *days))
    # Lines without a record (appended ones) are kept as they are.
    kept = F.coalesce(F.col("record"), F.concat(F.lit("\n"), F.sha2("value", 256)))
    latest = (rows.withColumn("record", kept).groupBy("record", *days)
                  .agg(F.max(F.struct("run", "at", "value")).alias("r")))
    merged = scratch_path(spark, "documents")
    latest.select(F.col("r.value").alias("value"), *days).write.parquet(merged)
    (spark.read.parquet(merged).hint("rebalance", *days).write.mode("append").partitionBy(*days).text(path))
    # A stop in between leaves records twice until their days are written again, never none.
    for f in replaced:
        move_to(spark, f, f"{path}/{SUPERSEDED}/{below(spark, path, f)}")
    spark.catalog.refreshByPath(path)


def days_touched(days: list) -> Column:
    """Partition predicate of some days (rows of yyyy, mm, dd)."""
    months: dict[tuple[int, int], list[int]] = {}
    for y, m, d in days:
        months.setdefault((int(y), int(m)), []).append(int(d))
    out = F.lit(False)
    for (y, m), own in sorted(months.items()):
        out = out | ((F.col("yyyy") == y) & (F.col("mm") == m) & F.col("dd").isin(own))
    return out


def _days_as_text(df: DataFrame) -> DataFrame:
    """Day folders as the text they are written as (a reader may take them for numbers)."""
    return df.withColumns({"yyyy": F.col("yyyy").cast("string"),
                           **{c: F.lpad(F.col(c).cast("string"), 2, "0") for c in ("mm", "dd")}})


def read_documents(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Documents in place: VARIANT column ``v`` plus the yyyy/mm/dd partitions.

    Read through the text source and ``try_parse_json``: one document per
    line, or one per file with ``whole_file=True``.  (The JSON source's
    ``singleVariantColumn`` mode fails in Spark 4.1 as soon as a partition
    column is filtered, which would forbid pruning by day.)
    """
    t = spark.read.text(path, wholetext=whole_file)
    parts = [c for c in t.columns if c != "value"]
    return t.select(J.parse("value").alias("v"), *parts)


def refresh_cache(spark: SparkSession, path: str) -> None:
    spark.catalog.refreshByPath(path)


def log_columns(ddl: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in ddl.split(",")]


def numbered_calls(calls: DataFrame, seq: str = "call_no") -> DataFrame:
    """``calls`` with gapless numbers from 0; equal calls are numbered each.

    Rows are written once with their partition and place; the partitions' counts
    (one row each) become offsets, so no task numbers more than its partition.
    """
    spark, path = calls.sparkSession, scratch_path(calls.sparkSession, "calls")
    calls.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(offsets), "_part")
                .withColumn(seq, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
                .drop("_part", "_before", "_at"))


def pack_log_batches(log: DataFrame, ts: str = "call_at", seq: str = "event_id",
                     rows: int = LOG_BATCH_ROWS, ddl: str = LOG_ROW_DDL) -> DataFrame:
    """Log rows -> JSON array texts of at most ``rows`` rows (per day and id block).

    Repeated rows of one ``seq`` (a re-delivered log) count once.
    """
    return (log.dropDuplicates([seq]).groupBy(F.to_date(ts).alias("day"), F.floor(F.col(seq) / rows).alias("block"))
            .agg(J.pack_json_array(*log_columns(ddl)).alias("batch")))


def unpack_log_batches(batches: DataFrame, batch: str = "batch", ddl: str = LOG_ROW_DDL,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of the arrays, with the columns ``keep`` of their batch."""
    return batches.select(*keep, F.inline(J.unpack_json_array(batch, ddl)))


def append_log_batches(batches: DataFrame, target: str, ddl: str = LOG_ROW_DDL) -> None:
    """Append unpacked log rows to the log table (parquet folder)."""
    unpack_log_batches(batches, ddl=ddl).write.mode("append").parquet(target)
