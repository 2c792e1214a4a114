"""Periodic CSV drops: read, type, load once, export.

Reading
-------
Every column is read as text with an explicit positional schema (no
inference pass over the data), ``mode=FAILFAST`` so a malformed line aborts
the read (a line feed inside quotes counts as one: drops have one record a
line, which lets plain files be split), and the source file of every row comes from ``_metadata``.  The
two NULL markers ('' and '-') are applied after the read because the CSV
reader accepts only one ``nullValue``.  Casting happens with ANSI casts,
so one bad number fails the whole load and nothing is appended (the write
job aborts before its commit).

Splits: gzip files are not splittable - one task per file - which is the
drop layout (one file per quarter); uncompressed drops split by
``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as TX
from ..session import below, move_to, path_exists, scratch_path
from .load_history import FAILED, LOADED, LoadHistory

# The revenue drop layout (positional columns and their types).
REVENUE_DROP_COLUMNS = (
    ("id", "string"), ("revenue_date", "date"), ("title", "string"),
    ("revenue", "decimal(12,0)"), ("theaters", "decimal(6,0)"), ("distributor", "string"))
DROP_SUFFIX = ".csv.gz"
# Columns declared NOT NULL in the raw revenue table.
REVENUE_REQUIRED = ("id", "revenue_date", "title")


def text_schema(columns: Sequence[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n, _ in columns])


def csv_reader(spark: SparkSession):
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("mode", "FAILFAST").option("nullValue", None).option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def typed(df: DataFrame, columns: Sequence[tuple[str, str]],
          null_markers: Sequence[str] = TX.CSV_NULL_MARKERS,
          required: Sequence[str] = ()) -> DataFrame:
    """Apply the NULL markers, then strict casts; keeps the lineage columns.

    A NULL in a ``required`` column raises while the rows are produced (no
    extra pass), so the load fails as a NOT NULL constraint would.
    """
    out = []
    for n, t in columns:
        c = TX.null_if_marker(n, null_markers).cast(t)
        if n in required:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"NULL in required column {n}"))
                       .cast(t)).otherwise(c)
        out.append(c.alias(n))
    extra = [c for c in df.columns if c not in {n for n, _ in columns}]
    return df.select(*out, *extra)


def read_drops(spark: SparkSession, path: str | Sequence[str],
               columns: Sequence[tuple[str, str]] = REVENUE_DROP_COLUMNS,
               loaded_at: str | None = None, recursive: bool = True,
               required: Sequence[str] | None = None) -> DataFrame:
    """Typed rows of CSV drops plus ``_source_file`` and ``_loaded_at``.

    ``required`` defaults to the NOT NULL columns of the revenue layout when
    that layout is read.
    """
    if required is None:
        required = REVENUE_REQUIRED if tuple(columns) == REVENUE_DROP_COLUMNS else ()
    r = csv_reader(spark).schema(text_schema(columns))
    if recursive:
        r = r.option("recursiveFileLookup", True)
    raw = r.csv(path if isinstance(path, str) else list(path))
    raw = raw.select(*[n for n, _ in columns], F.col("_metadata.file_path").alias("_source_file"))
    ts = F.to_timestamp_ntz(F.lit(loaded_at)) if loaded_at else F.localtimestamp()
    return typed(raw, columns, required=required).withColumn("_loaded_at", ts)


def records(spark: SparkSession, path: str | Sequence[str], quote: str = '"') -> DataFrame:
    """(file, record) of plain CSV files whose quoted fields may hold line feeds; every split is read by its own task.

    A line feed ends a record where the quotes before it, from the file's start,
    are even in number (a doubled quote keeps the parity).  So each split counts
    the quotes of its lines, the counts of a file's splits are summed up in their
    order (one row a split), and with that start each split knows which of its
    lines begin a record; the lines of a record are joined again by its number,
    also where it crosses splits.  A file's first record is its header and is
    left out; a carriage return before a record's end is dropped.
    """
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(
        path if isinstance(path, str) else list(path))
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                        F.monotonically_increasing_id().alias("at"), "value",
                        (F.length("value") - F.length(F.replace("value", F.lit(quote)))).alias("quotes"))
    kept = scratch_path(spark, "lines")
    lines.write.parquet(kept)  # the order of lines is that of this one read
    lines = spark.read.schema(lines.schema).parquet(kept)
    # One row for each split: the quotes before it, then the records that begin before it.
    splits = lines.groupBy("file", "split").agg(F.sum("quotes").alias("_q"))
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    start = splits.select("file", "split", F.coalesce(F.sum("_q").over(before), F.lit(0)).alias("_q0"))
    within = W.partitionBy("file", "split").orderBy("at")  # the lines of one split
    earlier = within.rowsBetween(W.unboundedPreceding, -1)
    known = lines.join(F.broadcast(start), ["file", "split"]).withColumn(
        "_odd", (F.col("_q0") + F.coalesce(F.sum("quotes").over(earlier), F.lit(0))) % 2)
    begun = known.select("file", "split", "at", "value", (F.col("_odd") == 0).cast("int").alias("_begins"))
    counted = scratch_path(spark, "begun")
    begun.write.parquet(counted)
    begun = spark.read.schema(begun.schema).parquet(counted)
    offsets = begun.groupBy("file", "split").agg(F.sum("_begins").alias("_b")).select(
        "file", "split", F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b0"))
    number = F.col("_b0") + F.sum("_begins").over(within.rowsBetween(W.unboundedPreceding, 0))
    numbered = begun.join(F.broadcast(offsets), ["file", "split"]).withColumn("_n", number)
    joined = numbered.where("_n > 1").groupBy("file", "_n").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("split", "at", "value"))), lambda x: x["value"]),
                     "\n").alias("record"))
    return joined.select("file", F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")


def read_quoted(spark: SparkSession, path: str | Sequence[str],
                columns: Sequence[tuple[str, str]] = REVENUE_DROP_COLUMNS, loaded_at: str | None = None,
                required: Sequence[str] | None = None) -> DataFrame:
    """Typed rows of plain drops whose quoted fields may hold line feeds (see ``records``), like ``read_drops``.

    Compressed drops cannot be split: read them with ``read_drops`` where no
    field holds a line feed.
    """
    if required is None:
        required = REVENUE_REQUIRED if tuple(columns) == REVENUE_DROP_COLUMNS else ()
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true", "emptyValue": "",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    parsed = records(spark, path).select(
        F.from_csv("record", ", ".join(f"`{n}` string" for n, _ in columns), options).alias("r"), "file")
    raw = parsed.select(*[F.col(f"r.{n}").alias(n) for n, _ in columns], F.col("file").alias("_source_file"))
    ts = F.to_timestamp_ntz(F.lit(loaded_at)) if loaded_at else F.localtimestamp()
    return typed(raw, columns, required=required).withColumn("_loaded_at", ts)


def load_file(spark: SparkSession, file: str, target: str,
              columns: Sequence[tuple[str, str]] = REVENUE_DROP_COLUMNS,
              loaded_at: str | None = None, mode: str = "append") -> int:
    """Append one drop to the raw table at ``target`` (or, with ``mode`` overwrite, put it there alone); returns rows.

    Any bad row raises (ANSI cast / FAILFAST) and the append is not committed.
    The row count is observed while writing, not by a second scan.
    """
    obs = Observation("load")
    df = read_drops(spark, file, columns, loaded_at, recursive=False)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(target)
    return int(obs.get["rows"])


def list_drops(spark: SparkSession, inbox: str, suffix: str = DROP_SUFFIX) -> DataFrame:
    """Drops in the inbox: ``path`` to read, ``uri`` as rows carry it, size and time (metadata only).

    Rows name their file by ``_metadata.file_path``, which encodes blanks,
    ``%`` and non-ASCII letters; the manifest compares that form.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*" + suffix)
            .option("recursiveFileLookup", True).load(inbox)
            .select("path", F.col("_metadata.file_path").alias("uri"), F.col("length").alias("size"),
                    F.unix_millis("modificationTime").alias("modified")))


def pending(spark: SparkSession, inbox: str, loaded_files: DataFrame | None = None,
            suffix: str = DROP_SUFFIX) -> DataFrame:
    """Drops not loaded yet (anti join against the manifest of loaded files)."""
    files = list_drops(spark, inbox, suffix)
    if loaded_files is None:
        return files
    return files.join(loaded_files.select(F.col("_source_file").alias("uri")).distinct(),
                      "uri", "left_anti")


def oldest_pending(spark: SparkSession, inbox: str, loaded_files: DataFrame | None = None,
                   suffix: str = DROP_SUFFIX) -> str | None:
    """Lexicographically smallest pending path, or None when the inbox is empty or not there."""
    if not path_exists(spark, inbox):
        return None
    return pending(spark, inbox, loaded_files, suffix).agg(F.min("path").alias("p")).first()["p"]


def literal_path(path: str) -> str:
    """A path in which nothing is a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def export_drops(df: DataFrame, path: str, partition_by: Sequence[str],
                 null_value: str = "", compression: str = "gzip") -> None:
    """Write history as per-period CSV in the layout it is read back with.

    Rows are rebalanced by the period columns: a period becomes one file (the
    drop layout) unless it is larger than the advisory partition size, when it
    is split over several tasks and files.  Blanks at either end of a text
    are kept.
    """
    (df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
     .option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("nullValue", null_value).option("compression", compression).csv(path))


def history_root(raw_root: str) -> str:
    """Where the load history of a raw table lies."""
    return raw_root.rstrip("/") + "_history"


def load_folder(raw_root: str, file: str, size: int, modified: int) -> str:
    """The folder of one delivery's rows: the same delivery, the same folder."""
    name = hashlib.sha256(f"{file}|{size}|{modified}".encode()).hexdigest()[:12]
    return f"{raw_root}/source=pickup/batch={int(name, 16)}"


def pickup_oldest(spark: SparkSession, inbox: str, raw_root: str,
                  columns: Sequence[tuple[str, str]] = REVENUE_DROP_COLUMNS,
                  loaded_at: str | None = None, archive_dir: str | None = None,
                  run_date: str | None = None, history: LoadHistory | None = None,
                  retry_failed: bool = False) -> dict | None:
    """Load the oldest drop not loaded yet; None when nothing is pending.

    The load history (by default beside the raw table) says which files are
    done.  A drop's rows go to a folder of their own, then its record is
    written: after a crash in between the same folder is written again.  A drop
    with a header only is recorded with 0 rows and passed over from then on.  A
    drop that cannot be loaded leaves no rows; it is recorded as FAILED, raises,
    and is passed over until ``retry_failed``.  With ``archive_dir`` a loaded
    file moves to its folder ``run_date=<run_date>``, under the path that it had
    below the inbox.  Returns {"file", "rows_loaded", "archived"}.
    """
    history = history or LoadHistory(spark, history_root(raw_root))
    if not path_exists(spark, inbox):
        return None
    files = list_drops(spark, inbox).withColumnRenamed("uri", "file")
    oldest = history.pending(files, retry_failed).agg(F.min(F.struct("path", "file", "size", "modified")).alias("f"))
    drop = oldest.first()["f"]
    if drop is None:
        return None
    entry = {k: drop[k] for k in ("file", "size", "modified")}
    folder = load_folder(raw_root, **entry)
    try:
        rows = load_file(spark, literal_path(drop["path"]), folder, columns, loaded_at, mode="overwrite")
    except Exception as ex:
        history.record([{**entry, "status": FAILED, "error": str(ex)[:500]}])
        raise
    history.record([{**entry, "status": LOADED, "rows": rows}])
    archived = archive_file(spark, inbox, drop["path"], archive_dir, run_date) if archive_dir else None
    return {"file": drop["path"], "rows_loaded": rows, "archived": archived}


def archive_folder(archive_dir: str, run_date: str | None) -> str:
    """The archive's folder of a run (by default the run of today, UTC)."""
    day = run_date or datetime.now(timezone.utc).date().isoformat()
    return f"{archive_dir}/run_date={day}"


def archive_file(spark: SparkSession, inbox: str, path: str, archive_dir: str, run_date: str | None = None) -> str:
    """Move a file of the inbox to the run's folder of the archive, its path below the inbox kept."""
    return move_to(spark, path, f"{archive_folder(archive_dir, run_date)}/{below(spark, inbox, path)}")
