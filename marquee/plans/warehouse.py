"""End-to-end runs over files, in the order of the original job chain.

    ingest_revenues  ->  enrichment_queue  ->  record_calls  ->  build

* ``ingest_revenues``: new CSV drops into the append-only raw table
  (exactly once per file, optional archive).
* ``enrichment_queue``: titles with revenue that are neither in the document
  cache nor failed today, by lifetime revenue, cut at min(requested, quota).
* ``record_calls``: the API results of one run (a DataFrame of responses -
  the HTTP calls themselves are outside Spark) are classified, found /
  not-found bodies are wrapped and written to the day-partitioned cache, and
  every call is appended to the call log.
* ``build``: staging and its checks, the four marts and theirs, written to a
  new version below ``out_root`` that is published only if all checks pass.

Every step is a Spark job over whole inputs; only scalars reach the driver
(the quota cap, failed check names).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import json as J
from ..functions import keys as K
from ..functions import outcome as O
from ..operators import marts, quality, queue, staging
from ..session import write_text
from ..sources import json_docs
from ..streaming import ingest

# The envelope status of a document.
DOC_STATUSES = (O.FOUND, O.NOT_FOUND)


def ingest_revenues(spark: SparkSession, inbox: str, raw_root: str, checkpoint: str,
                    archive_dir: str | None = None) -> int:
    return ingest.ingest_available(spark, inbox, raw_root, checkpoint, archive_dir=archive_dir)


def cached_lookups(spark: SparkSession, docs_root: str) -> DataFrame:
    """(lookup_title, lookup_year) of every cached document, any status."""
    return staging.docs_table(json_docs.read_documents(spark, docs_root)).select(
        "lookup_title", "lookup_year")


def enrichment_queue(spark: SparkSession, raw_root: str, docs_root: str, log: DataFrame,
                     as_of: str, requested: int = queue.DEFAULT_LIMIT) -> DataFrame:
    raw = ingest.read_raw(spark, raw_root)
    entities = queue.entity_keys(raw, key="title")
    on = [("title", "lookup_title"), ("release_year", "lookup_year")]
    errored = queue.errored_on(log, as_of, ["lookup_title", "lookup_year"])
    q = queue.fetch_queue(entities, cached_lookups(spark, docs_root), errored, on)
    return queue.take(q, queue.effective_limit(log, as_of, requested), "title")


def run_name(responses: DataFrame, fetched_at: str) -> str:
    """A run's name from its time and its calls: the same run repeated has the same name, another one has not."""
    row = F.xxhash64(*[F.col(c) for c in sorted(responses.columns)])
    n, total = responses.agg(F.count(F.lit(1)), F.sum(F.pmod(row, F.lit((1 << 40) - 87)))).first()
    return f"{fetched_at.replace(':', '').replace(' ', 'T')}-{n}-{total or 0:x}"


def record_calls(spark: SparkSession, responses: DataFrame, docs_root: str, log_root: str,
                 fetched_at: str, run_id: str | None = None) -> DataFrame:
    """Classify one run's responses, write documents, append the log.

    ``responses``: one row per call (equal calls are calls each): lookup_title,
    lookup_year, error_kind, http_status, reason, body (JSON text or NULL),
    write_ok (did the document write succeed), write_error.  The log gets one
    row per call, shipped in batches of up to 50 (``batch_no``), in the folder of
    the run: a run that is repeated rewrites its own rows.  ``run_id`` names the
    run; without it, its time and calls do, so two runs of one second are two
    unless they made the very same calls.  Returns the log rows appended.
    """
    run = f"{log_root}/run={run_id or run_name(responses, fetched_at)}"
    outcome, status, message = O.classify()
    r = json_docs.numbered_calls(responses.select("*", outcome.alias("outcome"), status.alias("status"),
                                                  message.alias("message")))
    ts = F.to_timestamp_ntz(F.lit(fetched_at))
    envelope = F.to_json(F.struct(
        F.struct(F.col("lookup_title").alias("title"), F.col("lookup_year").alias("year")).alias("_lookup"),
        F.col("outcome").alias("_status"),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("_fetched_at")))
    body = J.parse("body")
    docs = (r.where(F.col("outcome").isin(*DOC_STATUSES) & F.col("write_ok"))
            .select(J.merge_objects(envelope, "body").alias("doc_json"), ts.alias("fetched_at"),
                    K.record_id(J.vget(body, "$.imdbID"), "lookup_title", "lookup_year").alias("record")))
    json_docs.write_documents(docs, docs_root, key="record")
    final_outcome, final_message = O.remap_failed_write("outcome", "message", "write_ok", "write_error")
    calls = r.select("call_no", "lookup_title", "lookup_year", final_outcome.alias("outcome"),
                     F.col("status").alias("http_status"), final_message.alias("error_message"), ts.alias("call_at"))
    batches = json_docs.pack_log_batches(calls, seq="call_no", ddl=json_docs.CALL_ROW_DDL)
    log = (json_docs.unpack_log_batches(batches.withColumnRenamed("block", "batch_no"), ddl=json_docs.CALL_ROW_DDL,
                                        keep=("batch_no",))
           .select("lookup_title", "lookup_year", ts.alias("call_at"), "outcome", "http_status", "error_message",
                   "batch_no"))
    log.write.mode("overwrite").parquet(run)
    return spark.read.parquet(run)


def record_ids(docs: DataFrame) -> DataFrame:
    """Object path of each cached document (natural id or lookup hash)."""
    rid = K.record_id("imdb_id", "lookup_title", "lookup_year")
    return docs.select("lookup_title", "lookup_year", K.doc_object_path("_fetched_at", rid).alias("path"))


def build(spark: SparkSession, raw_root: str, docs_root: str, out_root: str, as_of: str,
          calendar: tuple[str, str] = (D.DEFAULT_SPINE_START, D.DEFAULT_SPINE_END),
          gate: bool = True) -> dict[str, DataFrame]:
    """Staging, marts and checks over the raw table and the document cache, then publish.

    Everything is written into a new version folder.  Failed staging checks
    stop the marts; failed mart checks stop the publication.  Only then does
    ``out_root/CURRENT`` name the new version: whoever reads through
    ``published`` sees the old one until that moment, and after a failure.
    """
    version = f"v-{uuid.uuid4().hex[:12]}"
    root = f"{out_root}/{version}"

    def write(name: str, df: DataFrame) -> DataFrame:
        return marts.materialize(spark, {name: df}, root)[name]

    stg = write("stg_revenues", staging.stg_revenues(ingest.read_raw(spark, raw_root)))
    docs = write("stg_docs", staging.stg_docs(
        staging.docs_table(json_docs.read_documents(spark, docs_root))))
    first = write("checks_staging", quality.staging_summary(stg))
    if gate:
        quality.gate(first)
    cal = write("dim_date", marts.dim_date(spark, *calendar))
    movies = write("dim_movie", marts.dim_movie(stg, docs))
    dists = write("dim_distributor", marts.dim_distributor(stg))
    fact = write("fact_daily_revenue", marts.fact_daily_revenue(stg, movies, dists))
    out = {"stg_revenues": stg, "stg_docs": docs, "dim_date": cal, "dim_movie": movies,
           "dim_distributor": dists, "fact_daily_revenue": fact}
    checks = write("checks", quality.star_summary(out, stg, as_of))
    out["checks"] = checks
    if gate:
        quality.gate(checks)
    write_text(spark, f"{out_root}/CURRENT", version)
    return out


def published(spark: SparkSession, out_root: str, name: str) -> DataFrame:
    """A table of the version that the last successful build published."""
    version = spark.read.text(f"{out_root}/CURRENT").first()[0]
    return spark.read.parquet(f"{out_root}/{version}/{name}")
