"""A frozen document listing: what is written is seen after a refresh, and not before."""
import os

from pyspark.sql import functions as F

from marquee.session import child_files, scratch_path
from marquee.sources import json_docs
from marquee.sources.frozen_docs import FrozenDocuments


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), "record string, x int, t string").select(
        "record", F.format_string('{"x":%d}', "x").alias("doc_json"), F.col("t").cast("timestamp_ntz").alias("fetched_at"))


def seen(cache, **named):
    return sorted(r.x for r in cache.read(**named).selectExpr("variant_get(v, '$.x', 'int') AS x").collect())


def test_appended_replaced_and_deleted_files(spark):
    root = f"{scratch_path(spark, 't-frozen')}/a b%20c"
    cache = FrozenDocuments(spark, root)
    assert seen(cache) == [] and cache.refresh() == {"added": 0, "removed": 0, "days": []}
    json_docs.write_documents(docs(spark, ("a", 1, "2024-01-30 09:00:00"), ("b", 2, "2024-01-31 09:00:00")), root)
    assert seen(cache) == []
    assert cache.refresh() == {"added": 2, "removed": 0, "days": ["20240130", "20240131"]}
    assert seen(cache) == [1, 2]
    json_docs.write_documents(docs(spark, ("c", 3, "2024-01-30 10:00:00")), root)  # one more file of a known day
    assert seen(cache) == [1, 2] and json_docs.read_documents(spark, root).count() == 3
    assert cache.refresh() == {"added": 1, "removed": 0, "days": ["20240130"]}
    assert seen(cache) == [1, 2, 3] and seen(cache, days=["20240131"]) == [2]
    again = FrozenDocuments(spark, root)  # another reader of the same listing
    day = again.listing.state()["parts"]["20240131"]
    os.unlink(child_files(spark, f"{root}/yyyy=2024/mm=01/dd=30")[0].removeprefix("file:"))
    assert again.refresh() == {"added": 0, "removed": 1, "days": ["20240130"]}
    assert again.listing.state()["parts"]["20240131"] == day  # an untouched day keeps its part of the listing


def test_a_replaced_day_is_read_as_it_was(spark):
    root = scratch_path(spark, "t-frozen-keyed")
    cache = FrozenDocuments(spark, root)
    write = lambda *rows: json_docs.write_documents(docs(spark, *rows), root, key="record")
    write(("a", 1, "2024-01-30 09:00:00"), ("b", 2, "2024-01-30 09:00:00"))
    cache.refresh()
    write(("a", 10, "2024-01-30 10:00:00"), ("c", 3, "2024-01-30 10:00:00"))
    write(("a", 11, "2024-01-30 11:00:00"))
    assert seen(cache) == [1, 2]
    assert sorted(r.x for r in json_docs.read_documents(spark, root).selectExpr(
        "variant_get(v, '$.x', 'int') AS x").collect()) == [2, 3, 11]
    cache.refresh()
    assert seen(cache) == [2, 3, 11]
    assert json_docs.SUPERSEDED not in os.listdir(root.removeprefix("file:"))
    assert seen(cache, days=["20240101"]) == []
