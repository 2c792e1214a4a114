import gzip
import json
import os
from decimal import Decimal

import pytest

from marquee.session import scratch_path
from marquee.sources import csv_drops, json_docs
from marquee.streaming import ingest

HEADER = "id,revenue_date,title,revenue,theaters,distributor\n"


def write_gz(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)


def test_csv_markers_quotes_lineage(spark):
    root = scratch_path(spark, "t-csv")
    write_gz(f"{root}/year=2003/data_2003q1.csv.gz",
             HEADER + '1,2003-01-01,"A, ""Q"" B",,-,-\n2,2003-01-02,B,100,12,Fox\n')
    df = csv_drops.read_drops(spark, root, loaded_at="2024-01-01 00:00:00")
    got = {r.id: r for r in df.collect()}
    assert got["1"].title == 'A, "Q" B'
    assert (got["1"].revenue, got["1"].theaters, got["1"].distributor) == (None, None, None)
    assert (got["2"].revenue, got["2"].theaters) == (Decimal(100), Decimal(12))
    assert got["2"]._source_file.endswith("year=2003/data_2003q1.csv.gz")


def test_bad_number_aborts_whole_load(spark):
    root = scratch_path(spark, "t-bad")
    write_gz(f"{root}/in/a.csv.gz", HEADER + "1,2003-01-01,A,10,1,X\n")
    write_gz(f"{root}/in/b.csv.gz", HEADER + "2,2003-01-01,B,abc,1,X\n")
    assert csv_drops.load_file(spark, f"{root}/in/a.csv.gz", f"{root}/raw") == 1
    with pytest.raises(Exception):
        csv_drops.load_file(spark, f"{root}/in/b.csv.gz", f"{root}/raw")
    assert spark.read.parquet(f"{root}/raw").count() == 1


def test_oldest_pending_and_manifest(spark):
    root = scratch_path(spark, "t-inbox")
    assert csv_drops.oldest_pending(spark, f"{root}/inbox") is None
    write_gz(f"{root}/inbox/year=2004/data_2004q1.csv.gz", HEADER)
    write_gz(f"{root}/inbox/year=2003/data_2003q4.csv.gz", HEADER)
    with open(f"{root}/inbox/notes.txt", "w") as f:
        f.write("x")
    first = csv_drops.oldest_pending(spark, f"{root}/inbox")
    assert first.endswith("year=2003/data_2003q4.csv.gz")
    loaded = spark.createDataFrame([(first,)], "_source_file string")
    nxt = csv_drops.oldest_pending(spark, f"{root}/inbox", loaded)
    assert nxt.endswith("year=2004/data_2004q1.csv.gz")


def test_export_roundtrip(spark):
    root = scratch_path(spark, "t-export")
    df = spark.createDataFrame([("1", "2003-02-01", 'x, "y"', "5", None, "-")],
                               "id string, revenue_date string, title string, revenue string, "
                               "theaters string, distributor string")
    from pyspark.sql import functions as F
    csv_drops.export_drops(df.withColumn("year", F.lit(2003)).withColumn("quarter", F.lit(1)),
                           root, ["year", "quarter"])
    back = csv_drops.read_drops(spark, root).first()
    assert (back.title, back.revenue, back.theaters, back.distributor) == ('x, "y"', Decimal(5), None, None)


def test_stream_loads_each_file_once(spark):
    root = scratch_path(spark, "t-stream")
    inbox, raw, ckpt, arch = f"{root}/inbox", f"{root}/raw", f"{root}/ckpt", f"{root}/archive"
    assert ingest.ingest_available(spark, inbox if os.path.isdir(inbox) else _mk(inbox), raw, ckpt) == 0
    write_gz(f"{inbox}/q1.csv.gz", HEADER + "1,2003-01-01,A,10,1,X\n2,2003-01-01,B,20,1,X\n")
    assert ingest.ingest_available(spark, inbox, raw, ckpt, archive_dir=arch) == 1
    assert ingest.ingest_available(spark, inbox, raw, ckpt, archive_dir=arch) == 0   # same files
    write_gz(f"{inbox}/q2.csv.gz", HEADER + "2,2003-01-01,B,25,1,X\n")               # re-delivery
    assert ingest.ingest_available(spark, inbox, raw, ckpt, archive_dir=arch) == 1
    r = ingest.read_raw(spark, raw)
    assert r.count() == 3
    latest = {x.id: x.revenue for x in ingest.latest_rows(
        r, "id", ["revenue_date", "title", "revenue", "theaters", "distributor"]).collect()}
    assert latest == {"1": Decimal(10), "2": Decimal(25)}
    archived = [f for _, _, names in os.walk(arch) for f in names if f.endswith(".csv.gz")]
    assert sorted(archived) == ["q1.csv.gz", "q2.csv.gz"] and not [f for f in os.listdir(inbox) if f.endswith(".gz")]
    assert all(d.startswith("run_date=") for d in os.listdir(arch))


def test_fresh_checkpoint_loses_and_repeats_nothing(spark):
    root = scratch_path(spark, "t-restart")
    inbox, raw = f"{root}/in box%20", f"{root}/raw"
    write_gz(f"{inbox}/q 1%.csv.gz", HEADER + "1,2003-01-01,A,10,1,X\n")
    assert ingest.ingest_available(spark, inbox, raw, f"{root}/c1") == 1
    write_gz(f"{inbox}/q2.csv.gz", HEADER + "2,2003-01-01,B,20,1,X\n")
    ingest.ingest_available(spark, inbox, raw, f"{root}/c2")
    ingest.ingest_available(spark, inbox, raw, f"{root}/c1")
    assert sorted(r.id for r in ingest.read_raw(spark, raw).collect()) == ["1", "2"]


def test_pickup_of_odd_names_once_and_archived(spark):
    root = scratch_path(spark, "t-odd")
    inbox, raw = f"{root}/inbox", f"{root}/raw"
    names = ["a b.csv.gz", "c%20d.csv.gz", "e[1]{2}.csv.gz", "\u00e9.csv.gz"]
    for i, n in enumerate(names):
        write_gz(f"{inbox}/{n}", HEADER + f"{i},2003-01-01,A,10,1,X\n")
    got = [csv_drops.pickup_oldest(spark, inbox, raw, archive_dir=f"{root}/arch" if i % 2 else None,
                                   run_date="2024-01-30") for i in range(5)]
    assert got[4] is None and [g["rows_loaded"] for g in got[:4]] == [1] * 4
    assert sorted(r.id for r in spark.read.parquet(raw).collect()) == list("0123")
    assert sorted(os.listdir(f"{root}/arch/run_date=2024-01-30")) == sorted(n for i, n in enumerate(names) if i % 2)
    assert got[1]["archived"].endswith("run_date=2024-01-30/c%20d.csv.gz")


def test_blanks_survive_export(spark):
    from pyspark.sql import functions as F
    root = scratch_path(spark, "t-blanks")
    df = spark.createDataFrame([("1", "2003-01-01", "  lead trail ", "5", "1", "X")],
                               "id string, revenue_date string, title string, revenue string, theaters string, "
                               "distributor string")
    csv_drops.export_drops(df.withColumn("year", F.lit(2003)), root, ["year"])
    assert csv_drops.read_drops(spark, root).first().title == "  lead trail "


def test_documents_written_again_stay_one(spark):
    root = scratch_path(spark, "t-docs-once")
    rows = lambda v: spark.createDataFrame(
        [("r1", f'{{"x":{v}}}', "2024-01-30 09:00:00"), ("r2", '{"x":7}', "2024-01-30 09:00:00")],
        "record string, doc_json string, t string").selectExpr("record", "doc_json", "cast(t AS timestamp_ntz) AS fetched_at")
    json_docs.write_documents(rows(1), root, key="record")
    json_docs.write_documents(rows(2), root, key="record")
    json_docs.write_documents(rows(2), root, key="record")
    got = json_docs.read_documents(spark, root).selectExpr("variant_get(v, '$.x', 'int') AS x", "yyyy", "mm", "dd").collect()
    assert sorted(r.x for r in got) == [2, 7]


def _mk(path):
    os.makedirs(path, exist_ok=True)
    return path


def test_documents_sink_and_scan(spark):
    from pyspark.sql import functions as F
    root = scratch_path(spark, "t-docs")
    env = spark.createDataFrame(
        [('{"_lookup":{"title":"A","year":2003},"_status":"found","imdbID":"tt1"}', "2024-01-03 10:00:00"),
         ('{"_lookup":{"title":"B","year":2003},"_status":"not_found"}', "2024-01-04 10:00:00")],
        "doc_json string, fetched_at string").withColumn("fetched_at", F.to_timestamp_ntz("fetched_at"))
    json_docs.write_documents(env, root)
    assert sorted(os.listdir(f"{root}/yyyy=2024/mm=01")) == ["dd=03", "dd=04"]
    d = json_docs.read_documents(spark, root)
    assert d.where("dd = 4").count() == 1
    json_docs.write_documents(env.limit(1), root)
    json_docs.refresh_cache(spark, root)
    assert json_docs.read_documents(spark, root).count() == 3


def test_log_batches_bounded(spark):
    import datetime as dt
    log = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 30, 1, 2, 3, 456789), i % 7, "found", 200, None) for i in range(120)],
        json_docs.LOG_ROW_DDL)
    b = json_docs.pack_log_batches(log)
    assert b.count() == 3
    back = json_docs.unpack_log_batches(b)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in log.collect())


def test_log_batches_stream_once(spark):
    import datetime as dt
    root = scratch_path(spark, "t-logstream")
    inbox, target, ckpt = f"{root}/inbox", f"{root}/log", f"{root}/ckpt"
    log = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, 30, 1, 0, 0, i), i, "found", 200, None) for i in range(120)],
        json_docs.LOG_ROW_DDL)
    batches = json_docs.pack_log_batches(log)
    batches.where("block < 2").select("batch").write.text(f"{inbox}/run1")
    assert ingest.ingest_log_batches(spark, inbox, target, ckpt, suffix=".txt") == 1
    assert ingest.ingest_log_batches(spark, inbox, target, ckpt, suffix=".txt") == 0
    batches.where("block = 2").select("batch").write.text(f"{inbox}/run2")
    assert ingest.ingest_log_batches(spark, inbox, target, ckpt, suffix=".txt") == 1
    got = spark.read.parquet(target).select(*log.columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in log.collect())


def test_compact_to_new_version(spark):
    root = scratch_path(spark, "t-compact")
    inbox, raw, ckpt = f"{root}/inbox", f"{root}/raw", f"{root}/ckpt"
    write_gz(f"{inbox}/a.csv.gz", HEADER + "1,2003-01-01,A,10,1,X\n2,2003-01-01,B,20,1,X\n")
    ingest.ingest_available(spark, inbox, raw, ckpt)
    write_gz(f"{inbox}/b.csv.gz", HEADER + "2,2003-01-01,B,30,1,X\n")
    ingest.ingest_available(spark, inbox, raw, ckpt)
    payload = ["revenue_date", "title", "revenue", "theaters", "distributor"]
    v1 = ingest.compact(spark, raw, f"{root}/v1", "id", payload)
    assert sorted((r.id, int(r.revenue)) for r in v1.collect()) == [("1", 10), ("2", 30)]


def test_documents_one_pretty_object_per_file(spark):
    from marquee.operators import staging
    root = scratch_path(spark, "t-docfiles")
    day = f"{root}/yyyy=2024/mm=01/dd=05"
    os.makedirs(day, exist_ok=True)
    for i, status in enumerate(["found", "not_found"]):
        doc = {"_lookup": {"title": f"T{i}", "year": 2003}, "_status": status,
               "_fetched_at": "2024-01-05T10:00:00+00:00", "imdbID": f"tt{i}", "Type": "movie",
               "Title": f"T{i}", "Ratings": [{"Source": "Rotten Tomatoes", "Value": "70%"}]}
        with open(f"{day}/tt{i}.json", "w") as f:
            json.dump(doc, f, indent=2)
    d = json_docs.read_documents(spark, root, whole_file=True)
    assert d.count() == 2 and d.where("dd = 5").count() == 2
    flat = staging.stg_docs(staging.docs_table(d)).collect()
    assert [(r.imdb_id, int(r.rotten_tomatoes_score)) for r in flat] == [("tt0", 70)]


def test_stream_replay_after_failure_does_not_duplicate(spark, monkeypatch):
    root = scratch_path(spark, "t-replay")
    inbox, raw, ckpt = f"{root}/inbox", f"{root}/raw", f"{root}/ckpt"
    write_gz(f"{inbox}/a.csv.gz", HEADER + "1,2003-01-01,A,10,1,X\n2,2003-01-01,B,20,1,X\n")
    real = ingest._batch_writer
    calls = {"n": 0}

    def crashing(*args):
        write = real(*args)

        def once(batch, batch_id):
            write(batch, batch_id)          # files written ...
            calls["n"] += 1
            if calls["n"] == 1:             # ... then the run dies before the batch commits
                raise RuntimeError("simulated failure after write")
        return once

    monkeypatch.setattr(ingest, "_batch_writer", crashing)
    with pytest.raises(Exception):
        ingest.ingest_available(spark, inbox, raw, ckpt)
    monkeypatch.setattr(ingest, "_batch_writer", real)
    assert ingest.ingest_available(spark, inbox, raw, ckpt) == 1   # the same batch is replayed
    assert ingest.ingest_available(spark, inbox, raw, ckpt) == 0
    assert ingest.read_raw(spark, raw).count() == 2                 # no duplicate rows


def test_pickup_oldest_in_name_order_once(spark):
    root = scratch_path(spark, "t-pickup")
    inbox, raw = f"{root}/inbox", f"{root}/raw"
    write_gz(f"{inbox}/year=2004/data_2004q1.csv.gz", HEADER + "3,2004-01-01,C,5,1,X\n")
    write_gz(f"{inbox}/year=2003/data_2003q4.csv.gz", HEADER + "1,2003-10-01,A,10,1,X\n2,2003-10-02,B,20,1,X\n")
    first = csv_drops.pickup_oldest(spark, inbox, raw)
    assert first["file"].endswith("data_2003q4.csv.gz") and first["rows_loaded"] == 2
    second = csv_drops.pickup_oldest(spark, inbox, raw)
    assert second["file"].endswith("data_2004q1.csv.gz") and second["rows_loaded"] == 1
    assert csv_drops.pickup_oldest(spark, inbox, raw) is None
    assert spark.read.parquet(raw).count() == 3


def test_export_one_file_per_quarter(spark):
    from pyspark.sql import functions as F
    root = scratch_path(spark, "t-export-layout")
    df = spark.range(400).select(F.col("id").cast("string").alias("id"),
                                 F.lit("2003-02-01").alias("revenue_date"), F.lit("T").alias("title"),
                                 F.lit("1").alias("revenue"), F.lit("1").alias("theaters"),
                                 F.lit("X").alias("distributor"),
                                 F.lit(2003).alias("year"), (F.col("id") % 4 + 1).alias("quarter")).repartition(8)
    csv_drops.export_drops(df, root, ["year", "quarter"])
    for q in range(1, 5):
        files = [f for f in os.listdir(f"{root}/year=2003/quarter={q}") if f.endswith(".csv.gz")]
        assert len(files) == 1
    assert csv_drops.read_drops(spark, root).count() == 400


def test_null_in_required_column_aborts_load(spark):
    root = scratch_path(spark, "t-required")
    write_gz(f"{root}/in/a.csv.gz", HEADER + "1,2003-01-01,A,10,1,X\n")
    write_gz(f"{root}/in/b.csv.gz", HEADER + "2,2003-01-01,,10,1,X\n3,2003-01-02,B,5,1,X\n")
    assert csv_drops.load_file(spark, f"{root}/in/a.csv.gz", f"{root}/raw") == 1
    with pytest.raises(Exception, match="required column title"):
        csv_drops.load_file(spark, f"{root}/in/b.csv.gz", f"{root}/raw")
    assert spark.read.parquet(f"{root}/raw").count() == 1
