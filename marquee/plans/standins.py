"""Stand-in inputs derived from the driver tables.

The driver data has no films, so each input of the pipeline is derived from
the TPC-H-like tables (every row of them; nothing is sampled):

* raw revenues = lineitem ⋈ part ⋈ supplier, one row per line item;
  id = orderkey*10 + linenumber repeats (re-deliveries for the de-dup),
  the title is part name + brand with messy spacing, the supplier
  'Supplier#000000001' stands for a missing distributor.
* documents = one JSON envelope per staged (title, release_year), built from
  the part row with the least partkey of that title; PROMO parts are
  'series', parts of size < 5 carry 'N/A' everywhere, MEDIUM parts have no
  Rotten Tomatoes rating.
* call log = events: every event is one API call of user ``user_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions import outcome as O
from ..functions import text as T
from ..operators import staging
from ..sources.tables import read_table

# Fixed values of the stand-in.
MISSING_DISTRIBUTOR = "Supplier#000000001"
SERIES_PART_TYPE = "PROMO"
NO_RT_PART_TYPE = "MEDIUM"
NA_BELOW_SIZE = 5
AS_OF = "2024-01-30"
AS_OF_TS = "2024-01-30 12:00:00"
FETCH_BASE_TS = "2024-01-01 06:00:00"


def raw_revenues(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
                   "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    j = l.join(p, l.l_partkey == p.p_partkey).join(s, l.l_suppkey == s.s_suppkey)
    ship = F.to_date("l_shipdate")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id"),
        ship.alias("revenue_date"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("  "), F.col("p_brand")).alias("title"),
        F.round("l_extendedprice").cast("decimal(12,0)").alias("revenue"),
        F.col("l_quantity").cast("decimal(6,0)").alias("theaters"),
        F.nullif(F.col("s_name"), F.lit(MISSING_DISTRIBUTOR)).alias("distributor"),
        F.concat(F.lit("year="), F.year(ship), F.lit("/data_"), F.year(ship), F.lit("q"),
                 F.quarter(ship), F.lit(".csv.gz")).alias("_source_file"),
        F.col("l_shipdate").alias("_loaded_at"),
    )


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_revenues(raw_revenues(spark, sf_dir))


def _na(cond, c):
    return F.when(cond, F.lit(T.DOC_NULL_MARKER)).otherwise(c)


def doc_envelopes(spark: SparkSession, sf_dir: str, stg_df: DataFrame | None = None) -> DataFrame:
    """One JSON text per staged film: envelope merged with the API body.

    Columns: doc_json (text), fetched_at (timestamp_ntz).
    """
    stg_df = stg_df if stg_df is not None else stg(spark, sf_dir)
    films = stg_df.groupBy("title").agg(F.min("release_year").alias("release_year"))
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type",
                   "p_size", "p_retailprice")
    first_part = (p.withColumn("title", T.normalize_ws(F.concat_ws(" ", "p_name", "p_brand")))
                  .groupBy("title")
                  .agg(F.min_by(F.struct("p_partkey", "p_name", "p_brand", "p_type", "p_size",
                                         "p_retailprice"), F.col("p_partkey")).alias("p"))
                  .select("title", "p.*"))
    d = films.join(first_part, "title")
    na = F.col("p_size") < NA_BELOW_SIZE
    # rating in tenths = 2 * size, written 'd.d' (size 23 -> '4.6')
    rating = F.expr("concat(cast((p_size * 2) div 10 as string), '.', cast((p_size * 2) % 10 as string))")
    rt = (F.col("p_size") * 2).cast("string")
    ratings = F.when(na, F.array().cast("array<struct<Source:string,Value:string>>")).otherwise(
        F.when(F.col("p_type") == NO_RT_PART_TYPE,
               F.array(F.struct(F.lit("Internet Movie Database").alias("Source"),
                                F.concat(rating, F.lit("/10")).alias("Value"))))
        .otherwise(F.array(F.struct(F.lit("Internet Movie Database").alias("Source"),
                                    F.concat(rating, F.lit("/10")).alias("Value")),
                           F.struct(F.lit("Rotten Tomatoes").alias("Source"),
                                    F.concat(rt, F.lit("%")).alias("Value")))))
    fetched = (F.to_timestamp_ntz(F.lit(FETCH_BASE_TS))
               + F.make_dt_interval(F.col("p_size") - 1)).alias("fetched_at")
    body = F.to_json(F.struct(
        _na(na, F.upper("p_name")).alias("Title"),
        _na(na, F.col("release_year").cast("string")).alias("Year"),
        _na(na, F.lit("PG-13")).alias("Rated"),
        _na(na, F.concat(F.lit("01 Jan "), F.col("release_year").cast("string"))).alias("Released"),
        _na(na, F.concat(F.col("p_size").cast("string"), F.lit(" min"))).alias("Runtime"),
        _na(na, F.initcap("p_type")).alias("Genre"),
        _na(na, F.col("p_brand")).alias("Director"),
        _na(na, F.col("p_name")).alias("Writer"),
        _na(na, F.concat(F.col("p_brand"), F.lit(" ensemble"))).alias("Actors"),
        _na(na, F.concat(F.lit("A story about a "), F.col("p_name"))).alias("Plot"),
        _na(na, F.lit("English")).alias("Language"),
        _na(na, F.lit("USA")).alias("Country"),
        F.lit(T.DOC_NULL_MARKER).alias("Awards"),
        _na(na, F.concat(F.lit("poster_"), F.col("p_partkey").cast("string"), F.lit(".jpg"))).alias("Poster"),
        ratings.alias("Ratings"),
        _na(na, (F.col("p_size") * 2).cast("string")).alias("Metascore"),
        _na(na, rating).alias("imdbRating"),
        _na(na, F.format_number(F.col("p_partkey") * 37 + 1000, 0)).alias("imdbVotes"),
        F.concat(F.lit("tt"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("imdbID"),
        F.when(F.col("p_type") == SERIES_PART_TYPE, F.lit("series")).otherwise(F.lit("movie")).alias("Type"),
        _na(na, F.concat(F.lit("$"), F.format_number(F.round(F.col("p_retailprice") * 1000), 0))).alias("GrossRevenue"),
        F.lit("True").alias("Response"),
    ))
    envelope = F.to_json(F.struct(
        F.struct(F.col("title").alias("title"), F.col("release_year").alias("year")).alias("_lookup"),
        F.lit("found").alias("_status"),
        F.concat(F.date_format(fetched, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("_fetched_at"),
    ))
    return d.select(J.merge_objects(envelope, body).alias("doc_json"), fetched)


def docs(spark: SparkSession, sf_dir: str, stg_df: DataFrame | None = None) -> DataFrame:
    """The document table (external-table columns) over the envelopes."""
    env = doc_envelopes(spark, sf_dir, stg_df)
    return staging.docs_table(env.select(J.parse("doc_json").alias("v")))


def api_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw API responses, one per event: (error_kind, http_status, reason, body)."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    et, v = F.col("event_type"), F.col("value")
    is_err = et == "error"
    error_kind = (F.when(is_err & (v < 20), F.lit("timeout"))
                  .when(is_err & (v < 40), F.lit("other")))
    http = (F.when(is_err & (v < 40), F.lit(None).cast("int"))
            .when(is_err & (v < 120), F.lit(429))
            .when(is_err & (v < 250), F.lit(503))
            .when(is_err, F.lit(404))
            .otherwise(F.lit(200)))
    reason = (F.when(is_err & (v < 40), F.lit("connection reset by peer"))
              .when(is_err & (v < 250), F.lit("Service Unavailable"))
              .when(is_err, F.lit("Not Found"))
              .otherwise(F.lit("OK")))
    body = (F.when(et == "view", F.lit('{"Response":"False","Error":"Movie not found!"}'))
            .when(et == "signup", F.lit('{"Search":[]}'))
            .when(~is_err, F.lit('{"Response":"True"}')))
    return e.select("event_id", F.col("ts").alias("call_at"), F.col("user_id").alias("lookup_key"),
                    "event_type", "value", error_kind.alias("error_kind"), http.alias("http_status"),
                    reason.alias("reason"), body.alias("body"))


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call log: outcome classified from the raw response of every call."""
    r = api_responses(spark, sf_dir)
    outcome, status, message = O.classify()
    return r.select("event_id", "call_at", "lookup_key", outcome.alias("outcome"),
                    status.alias("http_status"), message.alias("error_message"), "value")
