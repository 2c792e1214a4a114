"""Registered queries over whole tables: equal to their SQL, or to what their contract asks for."""
import zlib

import duckdb
import pytest

from marquee.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "embeddings", "conversations")


def plain(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda t: [(x is None, str(x)) for x in t])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got.collect(), got.columns) == plain(want.fetchall(), want.columns)


def ids(spark):
    return sorted(r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())


def test_line_dedup_query_covers_all_documents(spark):
    rows = QUERIES["op5_patience_line_dedup"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == ids(spark)
    assert all(0 <= r["n_cut"] <= r["n_lines"] for r in rows)


def test_toxicity_query_covers_all_documents(spark):
    rows = QUERIES["op10_crf_toxicity"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == ids(spark)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_packing_query_covers_all_documents(spark):
    rows = QUERIES["op7_online_packing"](spark, SF).collect()
    assert sorted({r["doc_id"] for r in rows}) == ids(spark)
    whole = {r["doc_id"]: r["doc_tokens"] for r in rows}
    got = dict.fromkeys(whole, 0)
    for r in rows:
        got[r["doc_id"]] += r["length"]
    assert got == whole


def test_decontamination_query_finds_planted_items(spark, duck):
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op6_simhash_decontamination"](spark, SF).collect()}
    whole = duck.sql("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)").fetchall()
    assert found >= set(whole)
