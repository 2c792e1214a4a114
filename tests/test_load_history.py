"""Load history: files without rows, equal names, crashes, failures, changed content; merges by key partition."""
import gzip
import os
import time

import pytest
from pyspark.sql import functions as F

from marquee.session import child_files, scratch_path
from marquee.sources import csv_drops
from marquee.sources.keyed_table import KeyedTable
from marquee.sources.load_history import FAILED, LOADED, LoadHistory, bucket_of
from marquee.streaming import ingest

HEADER = "id,revenue_date,title,revenue,theaters,distributor\n"


def drop(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(HEADER + "".join(line + "\n" for line in lines))


def ids(spark, raw):
    return sorted(r.id for r in spark.read.parquet(raw).collect())


def states(spark, raw):
    rows = LoadHistory(spark, csv_drops.history_root(raw)).latest().collect()
    return {r.file.split("/inbox/")[-1]: (r.status, r.rows) for r in rows}


def test_header_only_drop_is_recorded_and_passed_over(spark):
    root = scratch_path(spark, "t-header")
    inbox, raw = f"{root}/inbox", f"{root}/raw"
    drop(f"{inbox}/a.csv.gz")
    drop(f"{inbox}/b.csv.gz", "1,2003-01-01,A,10,1,X")
    got = [csv_drops.pickup_oldest(spark, inbox, raw) for _ in range(3)]
    assert [g and g["rows_loaded"] for g in got] == [0, 1, None]
    assert states(spark, raw) == {"a.csv.gz": (LOADED, 0), "b.csv.gz": (LOADED, 1)}


def test_equal_names_keep_their_paths_in_the_archive(spark):
    root = scratch_path(spark, "t-equal")
    inbox, raw, arch = f"{root}/inbox", f"{root}/raw", f"{root}/arch"
    for year in (2003, 2004):
        drop(f"{inbox}/year={year}/data.csv.gz", f"{year},{year}-01-01,A,10,1,X")
    run = dict(archive_dir=arch, run_date="2024-01-30")
    while csv_drops.pickup_oldest(spark, inbox, raw, **run):
        pass
    assert sorted(os.listdir(f"{arch}/run_date=2024-01-30")) == ["year=2003", "year=2004"]
    # The same path once more in one run: both stay.
    drop(f"{inbox}/year=2003/data.csv.gz", "9,2003-01-01,B,10,1,X")
    assert csv_drops.pickup_oldest(spark, inbox, raw, **run)["archived"].endswith("year=2003/data-2.csv.gz")
    assert ids(spark, raw) == ["2003", "2004", "9"]


def test_crash_between_rows_and_record_loads_once(spark, monkeypatch):
    root = scratch_path(spark, "t-crash")
    inbox, raw = f"{root}/inbox", f"{root}/raw"
    drop(f"{inbox}/a.csv.gz", "1,2003-01-01,A,10,1,X", "2,2003-01-01,B,10,1,X")

    def crash(self, *args, **named):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(LoadHistory, "record", crash)
        with pytest.raises(KeyboardInterrupt):
            csv_drops.pickup_oldest(spark, inbox, raw)
    assert csv_drops.pickup_oldest(spark, inbox, raw)["rows_loaded"] == 2
    assert csv_drops.pickup_oldest(spark, inbox, raw) is None
    assert ids(spark, raw) == ["1", "2"]


def test_failed_drop_is_recorded_and_can_be_retried(spark):
    root = scratch_path(spark, "t-failed")
    inbox, raw = f"{root}/inbox", f"{root}/raw"
    drop(f"{inbox}/a.csv.gz", "1,2003-01-01,A,abc,1,X")
    drop(f"{inbox}/b.csv.gz", "2,2003-01-01,A,10,1,X")
    with pytest.raises(Exception):
        csv_drops.pickup_oldest(spark, inbox, raw)
    assert csv_drops.pickup_oldest(spark, inbox, raw)["file"].endswith("b.csv.gz")
    assert csv_drops.pickup_oldest(spark, inbox, raw) is None
    assert states(spark, raw) == {"a.csv.gz": (FAILED, None), "b.csv.gz": (LOADED, 1)}
    with pytest.raises(Exception):
        csv_drops.pickup_oldest(spark, inbox, raw, retry_failed=True)
    time.sleep(0.01)
    drop(f"{inbox}/a.csv.gz", "1,2003-01-01,A,5,1,X")  # delivered again, mended: another delivery
    assert csv_drops.pickup_oldest(spark, inbox, raw)["rows_loaded"] == 1
    assert ids(spark, raw) == ["1", "2"]


def test_history_reads_only_the_buckets_asked_for_and_no_rows(spark):
    root = scratch_path(spark, "t-buckets")
    inbox, raw = f"{root}/inbox", f"{root}/raw"
    history = LoadHistory(spark, csv_drops.history_root(raw))
    history.record([{"file": f"f{i}", "size": 1, "modified": 1, "status": LOADED, "rows": i} for i in range(200)])
    history.record([{"file": f"f{i}", "size": 1, "modified": 1, "status": FAILED} for i in range(200)])
    files = spark.createDataFrame([("f3", 1, 1), ("f3", 2, 1), ("new", 1, 1)], "file string, size bigint, modified bigint")
    left = history.pending(files)
    assert sorted((r.file, r.size) for r in left.collect()) == [("f3", 2), ("new", 1)]
    plan = left._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan, plan
    assert raw + "/" not in plan
    before = sorted(map(str, history.latest().collect()))
    history.compact()
    assert sorted(map(str, history.latest().collect())) == before
    assert all(len(child_files(spark, f"{history.root}/bucket={b}")) == 1 for b in {bucket_of(f"f{i}") for i in range(200)})


def test_stream_records_and_archives_files_without_rows(spark):
    root = scratch_path(spark, "t-stream-header")
    inbox, raw = f"{root}/inbox", f"{root}/raw"
    drop(f"{inbox}/x/a.csv.gz")
    drop(f"{inbox}/y/a.csv.gz", "1,2003-01-01,A,10,1,X")
    run = dict(archive_dir=f"{root}/arch", run_date="2024-01-30")
    assert ingest.ingest_available(spark, inbox, raw, f"{root}/one", **run) == 1
    assert states(spark, raw) == {"x/a.csv.gz": (LOADED, 0), "y/a.csv.gz": (LOADED, 1)}
    assert sorted(os.listdir(f"{root}/arch/run_date=2024-01-30")) == ["x", "y"]
    drop(f"{inbox}/z/a.csv.gz", "2,2003-01-01,A,10,1,X")
    assert csv_drops.pickup_oldest(spark, inbox, raw)["rows_loaded"] == 1
    assert ingest.ingest_available(spark, inbox, raw, f"{root}/two") == 1  # a new stream leaves out what the pickup loaded
    assert ids(spark, raw) == ["1", "2"]


# --- merges ------------------------------------------------------------------------------

SCHEMA = "id bigint, v string, _batch_id bigint"


def table(spark, name):
    return KeyedTable(spark, scratch_path(spark, name), SCHEMA, "id", ["_batch_id"], partition=F.floor(F.col("id") / 10))


def rows(spark, batch, *pairs):
    return spark.createDataFrame([(i, v, batch) for i, v in pairs], SCHEMA)


def test_merge_rewrites_only_touched_partitions(spark):
    t = table(spark, "t-merge")
    assert t.read().collect() == []
    t.merge(rows(spark, 0, *[(i, "a") for i in range(100)]))
    old = t.state()["parts"]
    files = {p: sorted(child_files(spark, t._folder(p, v))) for p, v in old.items()}
    reader = t.read()
    out = t.merge(rows(spark, 1, (11, "b"), (17, "b"), (105, "new"), (11, "b")))
    assert out == {"version": 2, "rewritten": ["1", "10"]}
    now = t.state()["parts"]
    assert {p for p in now if now[p] != old.get(p)} == {"1", "10"}
    assert all(sorted(child_files(spark, t._folder(p, now[p]))) == files[p] for p in files if p != "1")
    got = {r.id: r.v for r in t.read().collect()}
    assert got == {**{i: "a" for i in range(100)}, 11: "b", 17: "b", 105: "new"}
    assert reader.count() == 100  # a reader sees the version it began with
    t.merge(rows(spark, 0, (11, "late")))  # an older row changes nothing
    assert {r.id: r.v for r in t.read().collect()} == got
    assert t.vacuum() >= 1 and {r.id: r.v for r in t.read().collect()} == got


def test_merge_is_applied_once_and_one_writer_wins(spark):
    t = table(spark, "t-applied")
    t.merge(rows(spark, 0, (1, "a")), applied=("s", 0))
    assert t.merge(rows(spark, 9, (1, "again")), applied=("s", 0))["rewritten"] == []
    assert [r.v for r in t.read().collect()] == ["a"]
    other = KeyedTable(spark, t.root, SCHEMA, "id", ["_batch_id"], partition=F.floor(F.col("id") / 10))
    stale = other.state()
    t.merge(rows(spark, 1, (2, "b")))
    other.state = lambda: stale  # began before the other's commit
    with pytest.raises(RuntimeError, match="another writer"):
        other.merge(rows(spark, 1, (3, "c")))
    assert sorted(r.id for r in t.read().collect()) == [1, 2]
    t.merge(rows(spark, 2).limit(0))
    t.merge(rows(spark, 3, (None, "x"), (None, "y")))
    assert sorted(str(r.id) for r in t.read().collect()) == ["1", "2", "None"]


def test_stream_merges_corrections_by_partition(spark):
    root = scratch_path(spark, "t-merge-stream")
    inbox = f"{root}/inbox"
    schema = ("id string, revenue_date date, title string, revenue decimal(12,0), theaters decimal(6,0), "
              "distributor string, _batch_id bigint")
    t = KeyedTable(spark, f"{root}/table", schema, "id", ["_batch_id"], partition=F.floor(F.col("id").cast("int") / 10))
    drop(f"{inbox}/1.csv.gz", *[f"{i},2003-01-01,A,10,1,X" for i in range(40)])
    assert ingest.merge_available(spark, inbox, t, f"{root}/ck")[0]["rewritten"] == ["0", "1", "2", "3"]
    drop(f"{inbox}/2.csv.gz", "12,2003-01-01,A,11,1,X")
    assert ingest.merge_available(spark, inbox, t, f"{root}/ck")[0]["rewritten"] == ["1"]
    assert ingest.merge_available(spark, inbox, t, f"{root}/ck") == []
    got = {r.id: int(r.revenue) for r in t.read().collect()}
    assert got == {**{str(i): 10 for i in range(40)}, "12": 11}
