"""Repeated substrings: rows of one id with other texts, null ids, planted passages beside clean documents, hot cores."""
import hashlib
import random

import pytest

from llm_rows import prose
from marquee.llm import queries, suffixes


def brute(texts, length):
    """Removed bytes by counting every string of every text."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i:i + length]] = seen.get(d[i:i + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        out.append((len(d), bytes(x for x, g in zip(d, gone) if not g)))
    return out


def test_rows_are_judged_by_their_own_text(spark):
    passage = prose(1, 120)
    rows = [(1, passage + prose(2, 60)), (1, prose(3, 200)), (2, prose(4, 50) + passage), (None, prose(5, 200)),
            (None, passage), (None, None), (3, prose(6, 90)), (3, prose(6, 90)), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((str(r["doc_id"]), r["n_bytes"], bytes(r["kept"])) for r in suffixes.substring_dedup(df).collect()))
    want = sorted((str(i), *b) for (i, _), b in zip(rows, brute([t for _, t in rows], 400)))
    assert got == want


def test_planted_passages_go_and_clean_documents_stay(spark, tmp_path):
    rng = random.Random(4)
    passages = [prose(50 + k, 60 + 15 * k) for k in range(6)]  # over 50 words, 400 bytes and more
    assert all(len(p.split()) > 50 and len(p.encode()) >= 400 for p in passages)
    planted = [prose(100 + k, 80) + " " + passages[k % 6] + " " + prose(200 + k, 80) for k in range(30)]
    clean = [prose(300 + k, rng.randrange(20, 300)) for k in range(60)]
    df = spark.createDataFrame(list(enumerate(planted + clean)), "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op4_suffix_dedup(spark, str(tmp_path)).collect()}
    for i, text in enumerate(planted + clean):
        r, size = got[i], len(text.encode())
        assert (r["n_bytes"], r["kept_bytes"]) == (size, size - r["n_removed"])
        assert r["has_repeats"] == (r["n_removed"] > 0) == (r["n_spans"] > 0) == (i < 30)
        if i < 30:
            assert r["n_removed"] >= len(passages[i % 6].encode())
        else:
            assert r["kept_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("heavy", [2, 5])
def test_hot_cores_are_cut_finer(spark, monkeypatch, heavy):
    """A passage between ever other neighbours: its cores have many kinds of stretch, at every step."""
    monkeypatch.setattr(suffixes, "HEAVY", heavy)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 4000)
    rng = random.Random(heavy)
    passage = prose(9, 90)
    texts = [prose(20 + k, 5)[:rng.randrange(30)] + passage[rng.randrange(4):len(passage) - rng.randrange(6)]
             + prose(60 + k, 5)[:rng.randrange(40)] for k in range(40)]
    texts += [passage[:70] + prose(1, 30), "ab" * 200, "z" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for length in (60, 200):
        got = {r["doc_id"]: (r["n_bytes"], bytes(r["kept"])) for r in suffixes.substring_dedup(df, length).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, length)
