"""Periodic runs and exact top-k search against brute force, and the rows that they must take."""
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_rows import CLASHES, prose
from marquee.llm import runs, topk
from marquee.llm.queries import QUERIES, repeated_tails


# --- periodic runs ------------------------------------------------------------------

def plain_runs(words, shortest=6, exponent=4):
    """Every run by trying every period: stretches in which words q apart are equal."""
    codes = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if words else np.zeros(0)
    out = []
    for q in range(1, len(words) // exponent + 1):
        equal = np.concatenate([[0], codes[q:] == codes[:-q], [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(equal))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length, part = stop + q - start, codes[start:stop + q]
            if length >= max(shortest, exponent * q) and not any(
                    np.array_equal(part[p:], part[:-p]) for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n and doc_id is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), best[0], best[1], best[2], best[1] and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def random_words(rng):
    n, kinds = rng.choice([0, 1, 5, 30, 80, 200]), rng.choice([1, 2, 3, 20])
    words = [rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + rng.randrange((n - a) // 4 + 1)
        words[a:] = [words[a + i % p] for i in range(n - a)]
        if rng.random() < 0.5:
            words[rng.randrange(n)] = 99
    return words


def test_runs_equal_trying_every_period():
    rng = random.Random(7)
    for _ in range(400):
        rows = [random_words(rng) for _ in range(rng.randint(1, 5))]
        first = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        got = runs.find_runs(np.array([w for r in rows for w in r], np.uint64), first)
        want = [(s + int(first[i]), length, q) for i, r in enumerate(rows) for s, length, q in plain_runs(r)]
        assert list(zip(*(x.tolist() for x in got))) == want


def test_wavelet_matrix_and_suffixes():
    rng = np.random.default_rng(3)
    values = rng.permutation(300)
    matrix = runs.WaveletMatrix(values)
    for _ in range(300):
        lo, hi = sorted(rng.integers(0, 301, 2))
        x = int(rng.integers(0, 600))
        part = np.sort(values[lo:hi])
        want = part[part >= x][0] if (part >= x).any() else runs.FAR
        assert matrix.successor(np.array([lo]), np.array([hi]), np.array([x]))[0] == want
    text = np.append(rng.integers(1, 3, 200), 0)
    suffixes = runs.Suffixes(text)
    assert suffixes.array.tolist() == sorted(range(201), key=lambda i: text[i:].tolist())


def test_registered_runs_query_equals_brute_force(spark):
    dir_ = "/root/testdata/sf0.001"
    got = {tuple(r) for r in QUERIES["op13_periodic_runs"](spark, dir_).collect()}
    docs = spark.read.parquet(f"{dir_}/documents.parquet").select("doc_id", "text").collect()
    assert got == {plain_row(*r) for r in docs}
    assert any(r[1] for r in got)


def test_runs_messy(messy, nothing):
    out = runs.run_digests(runs.periodic_runs(messy, rewrite=repeated_tails))
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = sorted((plain_row(r["doc_id"], r["text"]) for r in messy.collect()), key=str)
    assert got == want
    assert runs.periodic_runs(nothing).collect() == []
    plain = {r["doc_id"]: r for r in runs.periodic_runs(messy).collect()}
    assert plain[13]["runs"] == [(0, 10, 1)] and plain[13]["collapsed"] == "same"
    with pytest.raises(ValueError):
        runs.periodic_runs(messy, exponent=3)


def test_very_long_and_fully_periodic_texts(make):
    texts = ["x " * 30_000, "a b c " * 9_000, prose(5, 20_000) + " " + "p q " * 8_000]
    got = {r["doc_id"]: r["runs"] for r in runs.periodic_runs(make(texts)).collect()}
    assert got[0] == [(0, 30_000, 1)] and got[1] == [(0, 27_000, 3)] and got[2] == [(20_000, 16_000, 2)]


# --- top-k --------------------------------------------------------------------------

def plain_top(rows, k, divisor, scale=256):
    """Every query row against every other row."""
    ok = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(ok):
        if q % divisor == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), i) for b, (i, w) in enumerate(ok) if a != b)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def clustered(rng, n, size=8):
    centres = rng.normal(size=(6, size))
    return [(i, (centres[rng.integers(6)] + 0.2 * rng.normal(size=size)).tolist()) for i in range(n)]


@pytest.mark.parametrize("annulus, block, pivots", [(7, 3, 4), (64, 16, 8), (8192, 2048, 64)])
def test_top_k_equals_brute_force(spark, annulus, block, pivots):
    rng = np.random.default_rng(annulus)
    rows = clustered(rng, 300)
    hot = rows[0][1]
    rows += [(300 + i, hot) for i in range(150)]  # a third are copies of one vector
    rows += [(450 + i, [0.0] * 8) for i in range(5)] + [(460, (np.array(hot) * 40).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    back = [(r[0], r[1]) for r in df.collect()]
    got = topk.exact_top_k(df, df.filter("vec_id % 10 = 0"), k=5, annulus=annulus, query_block=block, pivots=pivots)
    assert sorted(map(tuple, got.collect())) == plain_top(back, 5, 10)


def test_top_k_messy(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [5.0, -1.0]), (1, [1.0, 2.0]), (2, []), (3, None), (4, [1.0, None]),
            (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [9.0, 9.0]), (7, [3.0]), (8, [1e9, -1e9]), (10, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
    pad = [(i, None if v is None else v + [0.0] * (2 - len(v))) for i, v in rows]
    got = topk.exact_top_k(df, df.filter("vec_id % 10 = 0"), k=3, annulus=2, query_block=2, pivots=2)
    assert sorted(map(tuple, got.collect())) == plain_top(pad, 3, 10)
    assert topk.exact_top_k(df.limit(0), df.limit(0)).collect() == []
    alone = df.filter("vec_id = 10")
    assert topk.exact_top_k(alone, alone).collect() == []


def test_top_k_beyond_doubles():
    big = np.array([[2 ** 40, 3], [-2 ** 62, 5]], np.int64)
    got = topk._products(big, big)
    assert got[0, 0] == topk.LONG.max and got[0, 1] == topk.LONG.min
    assert topk._unpack(pa.array(topk._pack(big), pa.binary()), 2).tolist() == big.tolist()
