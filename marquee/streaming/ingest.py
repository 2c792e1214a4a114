"""Incremental, exactly-once ingestion of CSV drops with Structured Streaming.

* The file source remembers every file it has read in the query checkpoint,
  so a re-run picks up only new files (load-once per file); files of a run are
  archived by run date once their rows are written.
* ``trigger(availableNow=True)`` processes everything pending and stops, the
  streaming form of "run the pickup now".
* Each micro-batch is written by ``foreachBatch`` into its own folder of its
  own stream with mode overwrite: a batch replayed after a failure rewrites
  the same folder instead of appending twice.
* Every file read, with or without rows, is recorded in the load history, which
  other loaders ask; nobody scans the rows for their file names.
* Late re-deliveries (same id in a newer file) are resolved on read by the
  latest-wins de-duplication over the append-only raw table (``latest_rows``),
  or merged as they come by the key partitions touched (``merge_available``).
* The checkpoint lives below the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import dedupe_latest
from ..session import child_files, read_text
from ..sources import csv_drops
from ..sources.keyed_table import KeyedTable
from ..sources.load_history import IDENTITY, LOADED, LoadHistory, bucket_of


def drop_stream(spark: SparkSession, inbox: str,
                columns: Sequence[tuple[str, str]] = csv_drops.REVENUE_DROP_COLUMNS,
                max_files_per_trigger: int | None = None,
                suffix: str = csv_drops.DROP_SUFFIX) -> DataFrame:
    r = (spark.readStream.schema(csv_drops.text_schema(columns))
         .option("header", True).option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("mode", "FAILFAST").option("pathGlobFilter", "*" + suffix)
         .option("recursiveFileLookup", True))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.csv(inbox).select(*[n for n, _ in columns],
                              F.col("_metadata.file_path").alias("_source_file"))
    required = csv_drops.REVENUE_REQUIRED if tuple(columns) == csv_drops.REVENUE_DROP_COLUMNS else ()
    return csv_drops.typed(raw, columns, required=required)


def _log_offset(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The last entry of the source's file log that a micro-batch read (-1 before the first)."""
    if batch_id < 0:
        return -1
    source = read_text(spark, f"{checkpoint}/offsets/{batch_id}").strip().splitlines()[-1]
    return int(json.loads(source)["logOffset"])


def batch_files(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str]:
    """The files that a micro-batch read, as rows name them; those without rows too.

    Read from the stream's own log of files, the entries of this batch only.
    """
    first, last = (_log_offset(spark, checkpoint, n) for n in (batch_id - 1, batch_id))
    log = f"{checkpoint}/sources/0"
    names = {f"{n}{end}" for n in range(first + 1, last + 1) for end in ("", ".compact")}
    paths = [f for f in child_files(spark, log) if f.rsplit("/", 1)[-1] in names]
    if not paths:
        return []
    entries = spark.read.text(paths).where(F.col("value").startswith("{")).select(
        F.from_json("value", "path string, batchId bigint").alias("e"))
    own = entries.where((F.col("e.batchId") > first) & (F.col("e.batchId") <= last))
    # The log writes an empty authority (file:///a), rows do not (file:/a).
    return sorted({re.sub(r"^([a-zA-Z][a-zA-Z0-9+.-]*):///", r"\1:/", r[0]) for r in own.select("e.path").collect()})


class _Run:
    """What the micro-batches of one run wrote and loaded."""

    def __init__(self, history: LoadHistory | None = None, inbox: str | None = None, suffix: str = csv_drops.DROP_SUFFIX):
        self.history, self.inbox, self.suffix = history, inbox, suffix
        self.folders: list[str] = []
        self.paths: list[str] = []


def _batch_writer(spark: SparkSession, target: str, checkpoint: str, run: _Run):
    """The function that writes a micro-batch and notes its folder.

    A batch is written to ``source=<id>/batch=<n>``, the id being that of the
    stream, which its checkpoint keeps: a replayed batch rewrites its own
    folder, and a stream with a fresh checkpoint cannot touch the folders of
    another.  Files that the load history has from another loader are left out;
    the batch's own files are recorded there once their rows are written.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        stream = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
        folder, files = f"{target}/source={stream}/batch={batch_id}", None
        if run.history is not None:
            names = batch_files(spark, checkpoint, batch_id)
            listed = csv_drops.list_drops(spark, run.inbox, run.suffix).withColumnRenamed("uri", "file")
            found = listed.where(F.col("file").isin(names))
            done = run.history.latest(sorted({bucket_of(n) for n in names})).where(
                (F.col("status") == LOADED) & (F.col("loader") != stream)).select(*IDENTITY, F.lit(True).alias("_done"))
            files = found.join(done, list(IDENTITY), "left").collect()  # the files of one micro-batch
            batch = batch.where(~F.col("_source_file").isin([f["file"] for f in files if f["_done"]]))
        (batch.withColumn("_loaded_at", F.localtimestamp())
              .withColumn("_batch_id", F.lit(batch_id).cast("long"))
              .write.mode("overwrite").parquet(folder))
        run.folders.append(folder)
        if files:
            count = {r["_source_file"]: r["n"] for r in spark.read.parquet(folder).groupBy("_source_file")
                     .agg(F.count(F.lit(1)).alias("n")).collect()}
            run.history.record([{**{c: f[c] for c in IDENTITY}, "status": LOADED, "rows": count.get(f["file"], 0)}
                                for f in files if not f["_done"]], loader=stream)
            run.paths += [f["path"] for f in files]
    return write


def _run_to_end(rows: DataFrame, target: str, checkpoint: str, run: _Run) -> None:
    """Run everything pending."""
    q = (rows.writeStream.foreachBatch(_batch_writer(rows.sparkSession, target, checkpoint, run))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_available(spark: SparkSession, inbox: str, target: str, checkpoint: str,
                     columns: Sequence[tuple[str, str]] = csv_drops.REVENUE_DROP_COLUMNS,
                     archive_dir: str | None = None, suffix: str = csv_drops.DROP_SUFFIX,
                     run_date: str | None = None, history: LoadHistory | None = None) -> int:
    """Load every drop not loaded before; returns the number of micro-batches run.

    The load history lies beside the table unless given.  With ``archive_dir``
    the files of this run, those without rows too, then move from the inbox to
    the archive's folder ``run_date=<run_date>``, their path below the inbox kept.
    """
    run = _Run(history or LoadHistory(spark, csv_drops.history_root(target)), inbox, suffix)
    _run_to_end(drop_stream(spark, inbox, columns, suffix=suffix), target, checkpoint, run)
    if archive_dir:
        for path in run.paths:  # as many as files in this run, which the stream has listed on the driver already
            csv_drops.archive_file(spark, inbox, path, archive_dir, run_date)
    return len(run.folders)


def merge_available(spark: SparkSession, inbox: str, table: KeyedTable, checkpoint: str,
                    columns: Sequence[tuple[str, str]] = csv_drops.REVENUE_DROP_COLUMNS,
                    suffix: str = csv_drops.DROP_SUFFIX, max_files_per_trigger: int | None = None) -> list[dict]:
    """Merge every drop not merged before into ``table``; returns what each micro-batch rewrote.

    The table keeps the latest row of each key, so readers need no de-duplication,
    and a micro-batch rewrites the key partitions that it touches.  Rows carry
    the number of their micro-batch as ``_batch_id``, which the table may order
    by.  A replayed micro-batch is applied once.
    """
    done: list[dict] = []

    def merge(batch: DataFrame, batch_id: int) -> None:
        stream = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
        rows = batch.withColumn("_loaded_at", F.localtimestamp()).withColumn("_batch_id", F.lit(batch_id).cast("long"))
        done.append(table.merge(rows, applied=(stream, batch_id)))

    rows = drop_stream(spark, inbox, columns, max_files_per_trigger, suffix)
    (rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
    return done


def read_raw(spark: SparkSession, target: str) -> DataFrame:
    """The append-only raw table (all batches; ``_batch`` from the folder names)."""
    return spark.read.parquet(target)


def compact(spark: SparkSession, raw_root: str, version_root: str, key: str | Sequence[str],
            payload: Sequence[str]) -> DataFrame:
    """Write the latest-wins view as a new version folder and return it.

    The raw table keeps growing with re-deliveries; readers switch to the
    compacted version (a parquet folder cannot be overwritten while it is
    being read, so a new folder is written instead of replacing in place).
    """
    keys = [key] if isinstance(key, str) else list(key)
    latest = latest_rows(read_raw(spark, raw_root), key, payload)
    latest.write.mode("overwrite").parquet(version_root)
    return spark.read.parquet(version_root).select(*keys, *[c for c in payload if c not in keys])


def latest_rows(raw: DataFrame, key: str | Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Latest-wins view: newest load (then newest batch) per key."""
    return dedupe_latest(raw, key, order_desc=["_loaded_at", "_batch_id", *payload],
                         keep=list(payload))


def ingest_log_batches(spark: SparkSession, inbox: str, target: str, checkpoint: str,
                       suffix: str = ".json", ddl: str | None = None) -> int:
    """Append call-log batch files (one JSON array per line) exactly once each.

    Every micro-batch unpacks its arrays with ``from_json`` + ``inline`` and
    is written into its own folder of the log table.
    """
    from ..sources import json_docs
    stream = (spark.readStream.option("pathGlobFilter", "*" + suffix)
              .option("recursiveFileLookup", True).text(inbox))
    rows = json_docs.unpack_log_batches(stream.withColumnRenamed("value", "batch"),
                                        ddl=ddl or json_docs.LOG_ROW_DDL)
    run = _Run()
    _run_to_end(rows, target, checkpoint, run)
    return len(run.folders)


DAY_CALLS = "day date, n_calls bigint, _v bigint"


def day_calls(spark: SparkSession, root: str) -> KeyedTable:
    """The table of calls per day that ``count_calls`` keeps (``queue.DAILY_QUOTA`` less these is what remains)."""
    return KeyedTable(spark, root, DAY_CALLS, "day", ["_v"], partition=F.year("day"))


def count_calls(spark: SparkSession, inbox: str, table: KeyedTable, checkpoint: str, lateness: str = "7 days",
                suffix: str = ".json", ddl: str | None = None, state_partitions: int = 8) -> int:
    """Count the calls of log batch files by day as they come; returns the number of micro-batches run.

    A stateful aggregate over days of event time: the state store holds one
    number a day until the watermark (the latest call less ``lateness``) has
    passed it, so a late call is counted into its own day, and a restart goes on
    from the checkpoint.  A call later than that is not counted.  Each
    micro-batch merges the days that it changed; ``state_partitions`` is small
    as the state is.
    """
    from ..sources import json_docs
    stream = (spark.readStream.option("pathGlobFilter", "*" + suffix)
              .option("recursiveFileLookup", True).text(inbox))
    rows = json_docs.unpack_log_batches(stream.withColumnRenamed("value", "batch"), ddl=ddl or json_docs.LOG_ROW_DDL)
    # Call times have no zone: as instants of UTC, in which windows of a day begin.
    instant = F.to_timestamp(F.concat(F.col("call_at").cast("string"), F.lit("Z")))
    counts = (rows.withColumn("call_at", instant).withWatermark("call_at", lateness)
                  .groupBy(F.window("call_at", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n_calls")))
    run = _Run()

    def merge(batch: DataFrame, batch_id: int) -> None:
        name = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
        day = F.date_from_unix_date(F.floor(F.unix_seconds("w.start") / 86_400).cast("int"))
        days = batch.select(day.alias("day"), "n_calls", F.lit(batch_id).cast("long").alias("_v"))
        table.merge(days, applied=(name, batch_id))
        run.folders.append(str(batch_id))

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        (counts.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.set(key, before)
    return len(run.folders)
