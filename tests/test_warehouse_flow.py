"""The whole job chain on reference-shaped files: drops, queue, calls, build, reports."""
import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from marquee.operators import measures
from marquee.plans import warehouse as W
from marquee.session import scratch_path

HEADER = "id,revenue_date,title,revenue,theaters,distributor\n"
AS_OF = "2024-01-30"


def drop(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(HEADER + "".join(line + "\n" for line in lines))


def body(imdb, title, **kw):
    b = {"Response": "True", "Type": "movie", "imdbID": imdb, "Title": title, "Director": "Dir",
         "imdbRating": "7.5", "GrossRevenue": "$1,000", "Runtime": "100 min",
         "Ratings": [{"Source": "Rotten Tomatoes", "Value": "90%"}]}
    b.update(kw)
    return json.dumps(b)


def test_job_chain(spark):
    root = scratch_path(spark, "t-flow")
    inbox, raw, docs, log_root = f"{root}/inbox", f"{root}/raw", f"{root}/omdb", f"{root}/log"
    drop(f"{inbox}/year=2003/data_2003q1.csv.gz", [
        '1,2003-01-03,"Big  Film",1000,10,Fox',
        "2,2003-01-04,Big Film,2000,10,Fox",
        "3,2003-01-04,Small Film,50,-,Fox",
        "4,2003-01-05,Other Film,700,5,-",
        "5,2003-01-05,Series X,300,5,Fox",
    ])
    assert W.ingest_revenues(spark, inbox, raw, f"{root}/ckpt") == 1
    drop(f"{inbox}/year=2003/data_2003q2.csv.gz", ["2,2003-01-04,Big Film,2500,10,Fox"])  # correction
    assert W.ingest_revenues(spark, inbox, raw, f"{root}/ckpt") == 1

    # Empty cache and log: the whole queue, by lifetime revenue (raw, before de-dup).
    empty_log = spark.createDataFrame([], "lookup_title string, lookup_year int, call_at timestamp_ntz, "
                                          "outcome string, http_status int, error_message string")
    os.makedirs(docs, exist_ok=True)
    q = W.enrichment_queue(spark, raw, docs, empty_log, AS_OF, requested=3)
    assert [r.title for r in q.collect()] == ["Big Film", "Other Film", "Series X"]

    responses = spark.createDataFrame([
        ("Big Film", 2003, None, 200, "OK", body("tt1", "BIG FILM"), True, None),
        ("Other Film", 2003, None, 503, "Service Unavailable", None, True, None),
        ("Series X", 2003, None, 200, "OK", body("tt3", "SERIES X", Type="series"), True, None),
        ("Small Film", 2003, None, 200, "OK", '{"Response":"False","Error":"Movie not found!"}', True, None),
    ], "lookup_title string, lookup_year int, error_kind string, http_status int, reason string, "
       "body string, write_ok boolean, write_error string")
    logged = W.record_calls(spark, responses, docs, log_root, "2024-01-30T09:00:00")
    assert sorted((r.lookup_title, r.outcome) for r in logged.collect()) == [
        ("Big Film", "found"), ("Other Film", "error_5xx"), ("Series X", "found"),
        ("Small Film", "not_found")]

    # The same run again leaves one document and one log row for each call.
    W.record_calls(spark, responses, docs, log_root, "2024-01-30T09:00:00")
    assert spark.read.parquet(log_root).count() == 4
    assert W.cached_lookups(spark, docs).count() == 3

    # Next queue: cached titles are gone, the failed one waits until tomorrow.
    log = spark.read.parquet(log_root)
    assert W.enrichment_queue(spark, raw, docs, log, AS_OF).count() == 0
    assert [r.title for r in W.enrichment_queue(spark, raw, docs, log, "2024-01-31").collect()] == ["Other Film"]

    out = W.build(spark, raw, docs, f"{root}/marts", AS_OF)
    fact = out["fact_daily_revenue"]
    # Only the enriched movie with a distributor reaches the fact; the correction wins.
    assert sorted((r.source_row_id, int(r.revenue)) for r in fact.collect()) == [("1", 1000), ("2", 2500)]
    d = out["dim_distributor"].first()
    assert (d.distributor_name, d.films_distributed_n, int(d.lifetime_revenue)) == ("Fox", 3, 3850)
    m = out["dim_movie"].first()
    assert (m.imdb_id, m.title, float(m.imdb_rating), int(m.rotten_tomatoes_score), int(m.box_office_omdb)) == \
        ("tt1", "BIG FILM", 7.5, 90, 1000)
    assert {r.check_name for r in out["checks"].where("status = 'fail'").collect()} == set()
    k = measures.kpi_cards(fact, out["dim_movie"]).first()
    assert (k.total_revenue, k.films_count, k.films_enriched) == (3500, 1, 1)
    paths = [r.path for r in W.record_ids(out["stg_docs"]).collect()]
    assert paths == ["raw/omdb/yyyy=2024/mm=01/dd=30/tt1.json"]


def test_build_gate_raises(spark):
    root = scratch_path(spark, "t-gate")
    drop(f"{root}/inbox/a.csv.gz", ["1,2030-01-03,Future Film,10,1,Fox"])
    W.ingest_revenues(spark, f"{root}/inbox", f"{root}/raw", f"{root}/ckpt")
    responses = spark.createDataFrame(
        [("Future Film", 2030, None, 200, "OK", body("tt9", "FUTURE"), True, None)],
        "lookup_title string, lookup_year int, error_kind string, http_status int, reason string, "
        "body string, write_ok boolean, write_error string")
    W.record_calls(spark, responses, f"{root}/omdb", f"{root}/log", "2024-01-30T09:00:00")
    span = ("2003-01-01", "2031-01-01")
    good = W.build(spark, f"{root}/raw", f"{root}/omdb", f"{root}/marts", "2031-01-01", calendar=span)
    with pytest.raises(RuntimeError, match="no_future_revenue_dates"):
        W.build(spark, f"{root}/raw", f"{root}/omdb", f"{root}/marts", AS_OF, calendar=span)
    # What was published stays, from the build that passed.
    assert W.published(spark, f"{root}/marts", "fact_daily_revenue").inputFiles() == \
        good["fact_daily_revenue"].inputFiles()


def test_staging_gate_stops_the_marts(spark):
    root = scratch_path(spark, "t-gate-staging")
    drop(f"{root}/inbox/a.csv.gz", ["1,2003-01-03,Film,-10,1,Fox"])
    W.ingest_revenues(spark, f"{root}/inbox", f"{root}/raw", f"{root}/ckpt")
    os.makedirs(f"{root}/omdb", exist_ok=True)
    with pytest.raises(RuntimeError, match="not_negative_stg_revenues_revenue"):
        W.build(spark, f"{root}/raw", f"{root}/omdb", f"{root}/marts", AS_OF)
    [version] = os.listdir(f"{root}/marts")
    assert "dim_movie" not in os.listdir(f"{root}/marts/{version}")


def test_command_line(spark, capsys):
    from marquee.__main__ import main
    root = scratch_path(spark, "t-cli")
    drop(f"{root}/inbox/a.csv.gz", ["1,2003-01-03,Film A,100,1,Fox", "2,2003-01-04,Film B,50,1,Fox"])
    assert main(["ingest", "--inbox", f"{root}/inbox", "--raw", f"{root}/raw"], spark) == 0
    assert '"batches": 1' in capsys.readouterr().out
    responses = spark.createDataFrame(
        [("Film A", 2003, None, 200, "OK", body("tt1", "FILM A"), True, None)],
        "lookup_title string, lookup_year int, error_kind string, http_status int, reason string, "
        "body string, write_ok boolean, write_error string")
    W.record_calls(spark, responses, f"{root}/omdb", f"{root}/log", "2024-01-30T09:00:00")
    assert main(["queue", "--raw", f"{root}/raw", "--docs", f"{root}/omdb", "--log", f"{root}/log",
                 "--as-of", "2024-01-31"], spark) == 0
    out = capsys.readouterr().out
    assert '"title": "Film B"' in out and "Film A" not in out
    assert main(["build", "--raw", f"{root}/raw", "--docs", f"{root}/omdb", "--out", f"{root}/marts",
                 "--as-of", "2024-01-31"], spark) == 0
    assert '"status": "pass"' in capsys.readouterr().out
