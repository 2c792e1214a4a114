"""Shards, packing, toxicity, decontamination, URL and licence filters, and the pipeline."""
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from llm_rows import prose
from marquee.llm import decontam, licenses, packing, shards, toxicity, urlgraph
from marquee.llm.queries import URL_RULES, vocabulary
from marquee.llm.tokens import ChunkTokenizer

VOCABULARY = vocabulary("word_bpe_49k.json")


# --- shards -----------------------------------------------------------------------

def test_shards_match_the_mixture(spark):
    sources = ["hot"] * 700 + ["b"] * 200 + ["c"] * 97 + [None] * 3
    df = spark.createDataFrame([(i, f"text {i % 50}", s) for i, s in enumerate(sources)],
                               "doc_id long, text string, source string")
    got = shards.shard_documents(df, 16, seed=3).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1000))
    count = Counter(r["shard"] for r in got)
    assert set(count) == set(range(16)) and max(count.values()) - min(count.values()) <= 1
    slots = defaultdict(list)
    mix = defaultdict(Counter)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        mix[r["shard"]][sources[r["doc_id"]]] += 1
        assert r["size"] == len(f"text {r['doc_id'] % 50}") + 1 and r["law"] == "rows" and r["grown_shard"] is None
        assert r["text_crc32"] == zlib.crc32(f"text {r['doc_id'] % 50}".encode())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(abs(m["hot"] - 700 / 16) <= 1 and abs(m["b"] - 200 / 16) <= 1 for m in mix.values())
    again = shards.shard_documents(df.repartition(7), 16, seed=3).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in got} == {(r["doc_id"], r["shard"], r["slot"]) for r in again}


def test_shards_messy(messy, nothing, tmp_path):
    got = shards.shard_documents(messy, 4).collect()
    assert len(got) == 17 and Counter(r["shard"] for r in got) == {0: 5, 1: 4, 2: 4, 3: 4}
    assert {r["size"] for r in got if r["doc_id"] in (5, 6)} == {1}
    assert shards.shard_documents(nothing).collect() == []
    clean = messy.filter("doc_id IS NOT NULL AND doc_id <> 2").select("doc_id", "text", "source")
    shards.write_shards(clean, str(tmp_path / "out"), 3)
    back = messy.sparkSession.read.parquet(str(tmp_path / "out"))
    assert Counter(r["shard"] for r in back.collect()) == {0: 5, 1: 4, 2: 4}


# --- tokens and packing -----------------------------------------------------------

TRICKY = ["it's they'll don't 'tis rock'n'roll x'(s a'.s", "a.b,c;d--e  f\tg h i", "ABC DéF ÉÈ ß İ ΑΣ Σ.",
          "3.14 12,5% #tag @x <|endoftext|> <|startoftext|>x", "éa ́b .́ á.", "\x01 a\x01b \x01\x01 ( \x01)",
          "漢字かな交じり、文。", "😀👍🏽 ok!!!???", "", " ", "\x00\x1f\x7f\x85 z", "a" * 5000, "'s 's's ''s s's"]


def test_chunks_give_the_ids_of_whole_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from marquee.llm.common import text_buffer
    rng = random.Random(4)
    texts = TRICKY + ["".join(rng.choice("ab.'’é1 \n,-(İΣ́\x01") for _ in range(60)) for _ in range(300)]
    plain = Tokenizer.from_file(VOCABULARY)
    plain.encode_special_tokens = True
    want = [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    tokenizer = ChunkTokenizer(VOCABULARY)
    for _ in range(2):  # learnt, then known
        ids, begin = tokenizer.encode(*text_buffer(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:])] == want


def check_packing(pieces, texts, size):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(VOCABULARY)
    plain.encode_special_tokens = True
    ids = [x.ids + [2] for x in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    assert set(by_doc) == set(range(len(texts)))
    for d, own in by_doc.items():
        own.sort(key=lambda p: p["start"])
        back = []
        for p in own:
            part = np.frombuffer(p["ids"], "<u4")
            assert p["start"] == len(back) and p["length"] == len(part) and p["doc_tokens"] == len(ids[d])
            assert p["ids_crc32"] == zlib.crc32(p["ids"])
            back += part.tolist()
        assert back == ids[d]
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= size
    return len(by_seq), sum(map(len, ids))


@pytest.mark.parametrize("fan_in", [2, 16])
def test_packing_round_trip(make, monkeypatch, fan_in):
    monkeypatch.setattr(packing, "MERGE_FAN_IN", fan_in)
    rng = random.Random(6)
    texts = [prose(k, rng.choice([3, 10, 40, 90, 300])) for k in range(150)] + ["", None, prose(9, 5000)]
    out = packing.pack(make(texts).repartition(9, "doc_id"), VOCABULARY, size=256, open_windows=4).collect()
    n, total = check_packing(out, texts, 256)
    assert total / (n * 256) > 0.85  # little padding


def test_packing_messy(messy, nothing):
    out = packing.pack(messy, VOCABULARY, with_ids=False)
    assert "ids" not in out.columns
    got = out.collect()
    assert Counter(p["doc_id"] for p in got if p["start"] == 0)[2] == 2  # a repeated row is packed twice
    assert {p["doc_tokens"] for p in got if p["doc_id"] in (5, 6, 7)} == {1}
    assert len({(p["sequence_id"], p["offset"]) for p in got}) == len(got)
    assert packing.pack(nothing, VOCABULARY).collect() == []


def test_open_windows_best_fit_and_bound():
    w = packing.OpenWindows(10, 2)
    assert w.place(6, 0) == (0, 0, [])
    assert w.place(7, 1) == (1, 0, [])
    assert w.place(3, 2) == (1, 7, [1])  # fits both: the fuller one, which closes
    assert w.place(9, 2) == (2, 0, [])
    assert w.place(8, 3) == (3, 0, [2])  # fits none, both in use: the fullest goes
    assert w.place(10, 4)[2] in ([3], [3, 4]) and len(w.used) <= 2


# --- toxicity -----------------------------------------------------------------------

def toxic_corpus(n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for k in range(n):
        w = prose(seed * 10_000 + k, rng.randrange(5, 80), 10**9).split(" ")
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                w.insert(rng.randrange(len(w) + 1), rng.choice(["Zorgling", "blarfy", "quexoz"]) + rng.choice(["", "s", "ed", ","]))
        texts.append(" ".join(w))
        labels.append(int(toxic))
    return texts, np.array(labels)


def test_crf_finds_toxic_spans_on_held_out_texts(make):
    texts, labels = toxic_corpus(300, 1)
    model = toxicity.fit(texts, labels)
    fresh, truth = toxic_corpus(200, 2)
    got = {r["doc_id"]: r for r in toxicity.score(make(fresh), model).collect()}
    said = np.array([got[i]["score"] >= 0.5 for i in range(200)])
    assert (said == truth).mean() >= 0.98
    for i in range(200):
        data = fresh[i].encode()
        found = [data[s["start"]:s["end"]].decode() for s in got[i]["spans"]]
        if truth[i] and said[i]:
            assert found and all(re.search("zorgling|blarfy|quexoz", f.lower()) for f in found)


def test_marginals_equal_enumeration():
    from itertools import product
    rng = np.random.default_rng(2)
    first = np.array([0, 4, 4, 5, 11])
    odds, trans, start = rng.uniform(0.2, 4, 11).astype(np.float32), rng.uniform(0.2, 3, (2, 2)), 0.7
    chains = toxicity.Chains(first)
    placed = np.empty_like(odds)
    placed[chains.at] = odds
    m, u, v = chains.marginals(placed, trans, start)
    m, pairs = m[chains.at], np.zeros((2, 2))
    for a, b in zip(first, first[1:]):
        total, mass, count = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in product((0, 1), repeat=b - a):
            p = np.prod([start ** y[0] if y else 1.0, *[odds[a + t] ** s for t, s in enumerate(y)],
                         *[trans[s, t] for s, t in zip(y, y[1:])]])
            total += p
            mass += p * np.array(y)
            for s, t in zip(y, y[1:]):
                count[s, t] += p
        assert np.allclose(m[a:b], mass / total, atol=1e-4)
        pairs += count / total
    assert np.allclose(chains.pair_counts(placed, trans, u, v), pairs, atol=1e-3)


def test_toxicity_messy(messy, nothing, spark):
    model = toxicity.fit(*toxic_corpus(200, 3))
    got = toxicity.score(messy, model).collect()
    assert len(got) == 17 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["spans"] == [] for r in got if r["doc_id"] in (5, 6, 7)} == {True}
    assert toxicity.score(nothing, model).collect() == []
    kept = toxicity.reject(messy, model)
    assert kept.columns == messy.columns and kept.count() == 17
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.train_and_score(messy, no_labels).collect()
    assert len(out) == 17 and {r["predicted"] for r in out} == {0}
    held = {r["doc_id"]: r["held_out"] for r in out}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in held if i is not None) and held[None] is False
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (4, 0), (999, 1)], "doc_id long, toxic int")
    assert len(toxicity.train_and_score(messy, labels, spans=True).collect()) == 17


def test_labels_of_the_held_out_fold_are_not_learnt(spark, make):
    texts, labels = toxic_corpus(300, 4)
    fold = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in range(300)])
    table = lambda y: spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, toxic int")
    one = toxicity.train_and_score(make(texts), table(labels)).collect()
    two = toxicity.train_and_score(make(texts), table(np.where(fold, 1 - labels, labels))).collect()
    assert {r["doc_id"]: r["score"] for r in one} == {r["doc_id"]: r["score"] for r in two}


# --- decontamination ----------------------------------------------------------------

def test_contaminated_equals_brute_force(spark, make):
    rng = random.Random(11)
    items = [prose(900 + k, rng.randrange(12, 50), 10**9) for k in range(40)] + ["only four words here", "", None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts, want = [], set()
    for k in range(120):
        w = prose(2000 + k, rng.randrange(20, 200), 10**9).split(" ")
        if k % 3 == 0:
            i = rng.randrange(40)
            leak = items[i].upper().split(" ") if k % 2 else re.sub(" ", ", ", items[i]).split(" ")
            at = rng.randrange(len(w) + 1)
            w[at:at] = leak
            want.add((k, i))
        elif k % 3 == 1:  # half of an item is no copy of it
            i = rng.randrange(40)
            part = items[i].split(" ")
            w[5:5] = part[:len(part) // 2]
        texts.append(" ".join(w))
    texts += ["x only four words here y", items[0], items[1] + " " + items[1]]
    want |= {(120, 40), (121, 0), (122, 1)}
    found = decontam.contaminated(make(texts), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    assert all(r["similarity"] >= 0.8 and r["distance"] <= 15 for r in found)
    plain = lambda t: re.findall("[a-z0-9]+", t.lower())
    for r in found:
        assert plain(texts[r["doc_id"]].encode()[r["byte_start"]:r["byte_end"]].decode()) == plain(items[r["item_id"]])
    assert decontam.decontaminate(make(texts), bench).count() == len(texts) - len({d for d, _ in want})


def test_multi_index_finds_all_within_the_radius():
    items = decontam.Items(np.arange(50), [prose(k, 20, 99) for k in range(50)], 5, 3)
    rng = np.random.default_rng(1)
    who = rng.integers(0, 50, 400)
    prints = items.prints[who].copy()
    for k in range(400):
        for bit in rng.choice(64, rng.integers(0, 16), replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(bit)
    w, i, d = items.lookup(prints)
    gaps = np.bitwise_count(prints[:, None] ^ items.prints[None])
    assert set(zip(w, i)) == set(zip(*np.nonzero(gaps <= 15)))
    assert (d == gaps[w, i]).all()


def test_contaminated_messy(messy, nothing, spark):
    bench = spark.createDataFrame([(1, prose(1, 30)), (2, None), (None, "a b c"), (3, ""), (4, "a b c"), (5, "word")],
                                  "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(messy, bench).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (11, 4), (8, 5), (9, 5)}
    assert decontam.contaminated(nothing, bench).collect() == []
    assert decontam.contaminated(messy, bench.limit(0)).collect() == []
    assert decontam.decontaminate(messy, bench).count() == 17 - 8


# --- URL and licence filters ----------------------------------------------------------

def test_rules_and_hosts(spark):
    rows = [(1, "http://Example.COM/en/x?q#f"), (2, "https://www.example.com/en/"), (3, "http://a.net/fr/1"),
            (4, "http://a.net?x=/es/"), (5, "http://notexample.com/en/"), (6, "http://netx/es/"), (7, "no scheme.com/"),
            (8, None), (9, "http://sub.www.example.com/en/y"), (10, "ftp://com/"), (10, "ftp://com/"), (None, "http://x.org#a/b")]
    pages = spark.createDataFrame([(*r, None) for r in rows], "page_id long, url string, html string")
    got = urlgraph.filter_urls(pages.selectExpr("*", "1 AS host", "2 AS verdict", "3 AS rule"), URL_RULES).collect()
    assert len(got) == 12
    by = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in got}
    assert by == {1: ("example.com", "/en/x", "example.com/en/"), 2: ("www.example.com", "/en/", "www.example.com/en/"),
                  3: ("a.net", "/fr/1", "net/fr/"), 4: ("a.net", "", None), 5: ("notexample.com", "/en/", "com/"),
                  6: ("netx", "/es/", None), 7: ("", "", None), 8: ("", "", None),
                  9: ("sub.www.example.com", "/en/y", "www.example.com/en/"), 10: ("com", "/", "com/"), None: ("x.org", "", None)}
    assert {r["page_id"]: r["verdict"] for r in got}[4] == "block"  # its host is blocked elsewhere
    assert urlgraph.filter_urls(pages.limit(0), URL_RULES).collect() == []


def test_trust_and_distrust_spread_over_links(spark):
    link = lambda *to: "".join(f'<a HREF = "//{t}/p">x</a><a href=/local>y</a>' for t in to)
    rows = [(1, "http://good.com/a", link("mid.org", "mid.org")), (2, "http://bad.net/es/a", link("good.com")),
            (3, "http://mid.org/a", link("far.org")), (4, "http://far.org/a", ""),
            (5, "http://farm.org/a", link("bad.net")), (6, "http://farm2.org/a", link("farm.org")), (7, "http://lone.org/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urlgraph.filter_urls(pages, URL_RULES).collect()}
    assert got == {1: "allow", 2: "block", 3: "allow", 4: "allow", 5: "block", 6: "block", 7: "allow"}
    # The scores equal power iteration on a matrix.
    links = [("good.com", "mid.org"), ("bad.net", "good.com"), ("mid.org", "far.org"), ("farm.org", "bad.net"), ("farm2.org", "farm.org"),
             ("good.com", "far.org")]
    hosts = sorted({h for e in links for h in e})
    seeds = spark.createDataFrame([(h, float(h == "good.com"), float(h == "bad.net")) for h in hosts], "host string, trust double, distrust double")
    scores = {r["host"]: (r["trust"], r["distrust"]) for r in urlgraph.spread(spark.createDataFrame(links, "src string, dst string"), seeds).collect()}
    for side, (a, b) in enumerate(((0, 1), (1, 0))):
        s0 = {h: 0.15 * (h == ("good.com", "bad.net")[side]) for h in hosts}
        s = dict(s0)
        for _ in range(12):
            out = Counter(e[a] for e in links)
            s = {h: s0[h] + sum(0.85 * s[e[a]] / out[e[a]] for e in links if e[b] == h) for h in hosts}
        assert all(abs(scores[h][side] - s[h]) < 1e-9 for h in hosts)


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    link = lambda to: f'<a href="//{to}/">x</a>'
    rows = [(0, "http://bad.net/es/a", "")] + [
        (k, f"http://h{k}.org/", link(f"h{k - 1}.org" if k > 1 else "bad.net")) for k in range(1, 31)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["verdict"] for r in urlgraph.filter_urls(pages, URL_RULES).collect()} == {"block"}


def test_scores_of_rings_converge_at_any_scale(spark):
    rng = random.Random(5)
    links = sorted({(f"h{k}", f"h{j}") for k in range(12) for j in [(k + 1) % 12, rng.randrange(12)] if j != k})
    hosts = [f"h{k}" for k in range(12)]
    at = {h: k for k, h in enumerate(hosts)}
    m = np.zeros((2, 12, 12))
    for a, b in links:
        m[0, at[b], at[a]] = 0.85 / sum(e[0] == a for e in links)
        m[1, at[a], at[b]] = 0.85 / sum(e[1] == b for e in links)
    edges = spark.createDataFrame(links, "src string, dst string")
    weight = 1e-9  # as in a table with a billion seeds
    seeds = spark.createDataFrame([("h0", weight, 0.0), ("h5", 0.0, weight)], "host string, trust double, distrust double")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in urlgraph.spread(edges, seeds).collect()}
    for side, seed in ((0, 0), (1, 5)):
        want = np.linalg.solve(np.eye(12) - m[side], 0.15 * weight * (np.arange(12) == seed))
        assert np.allclose([got[h][side] for h in hosts], want, rtol=1e-6, atol=0)


def test_licences_found_wherever_they_stand(make):
    rng = random.Random(21)
    texts, want = [], set()
    names = sorted(licenses.TEMPLATES)
    for k in range(90):
        w = prose(4000 + k, rng.randrange(5, 90), 10**9).split(" ")
        if k % 3:
            name = names[k % len(names)]
            t = licenses.TEMPLATES[name]
            t = t.upper() if k % 2 else "# " + t.replace(" ", "\n * ")
            at = rng.randrange(len(w) + 1)
            w[at:at] = t.split(" ")
            want.add((k, name))
        texts.append(" ".join(w))
    got = licenses.scan(make(texts)).collect()
    assert {(r["doc_id"], r["license"]) for r in got} >= want
    extra = {(r["doc_id"], r["license"]) for r in got} - want
    assert {n for _, n in extra} <= {"apache-2.0-line"}  # that line opens the longer notice
    # A long notice with one changed word in twenty is still found.
    w = licenses.TEMPLATES["mit-grant"].split(" ")
    changed = " ".join("changed" if i == 40 else x for i, x in enumerate(w))
    assert [r["license"] for r in licenses.scan(make(["lead in " + changed + " tail"])).collect()] == ["mit-grant"]


def test_licences_messy_and_native(messy, nothing, spark):
    assert licenses.scan(messy).collect() == []
    line = licenses.TEMPLATES["mit-line"]
    rows = spark.createDataFrame([(1, line), (1, "x " + line), (None, line)], "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["first_word"]) for r in licenses.scan(rows).collect()}
    assert got == {1: ("mit-line", 0), None: ("mit-line", 0)}
    assert licenses.scan(nothing).collect() == []
    assert licenses.scan(messy, {}).collect() == []
    with pytest.raises(ValueError):
        licenses.scan(messy, {"short": "three words only"})
    plans = [licenses.scan(messy)._jdf.queryExecution().toString(),
             urlgraph.filter_urls(rows.selectExpr("doc_id AS page_id", "text AS url", "text AS html"), URL_RULES)
             ._jdf.queryExecution().toString()]
    assert not any(re.search("Python|Pandas|Arrow", p) for p in plans)


# --- pipeline -----------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark, tmp_path):
    rng = random.Random(31)
    texts, toxic = toxic_corpus(160, 7)
    rows = [(i, t, int(y)) for i, (t, y) in enumerate(zip(texts, toxic))]
    base = prose(77, 200, 10)
    near = base.replace("\n", " ").split(" ")
    near[50] = "changed"
    item = prose(78, 30, 10**9)
    plus = {200: base, 201: base, 202: " ".join(near), 203: prose(79, 60) + "\n" + base.split("\n")[4] + "\n" + base.split("\n")[5],
            204: prose(80, 30, 10**9) + " " + item + " " + prose(81, 30, 10**9), 205: None, 206: "", 207: prose(82, 60, 10**9)}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t, _ in rows]
                                 + [(i, t, "en", "s", None if t is None else len(t)) for i, t in plus.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    stage, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, f in corpus_pipeline.STAGES:
        f(spark, stage, sf).write.parquet(f"{sf}/out-{name}")
        stage = spark.read.parquet(f"{sf}/out-{name}")
        out[name] = {r["doc_id"]: r for r in stage.collect()}
        if name != "packing":
            assert stage.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    after = lambda name: set(out[name])
    clean = {i for i, _, y in rows if not y}
    assert len(clean - after("toxicity")) <= 2 and len((set(range(160)) - clean) & after("toxicity")) <= 2
    assert after("toxicity") - after("line_dedup") == {201}
    assert out["line_dedup"][203]["text"] == plus[203].rsplit("\n", 2)[0] and out["line_dedup"][202]["text"] == plus[202]
    assert out["line_dedup"][203]["n_chars"] == len(out["line_dedup"][203]["text"])
    assert after("line_dedup") - after("near_dedup") == {202}
    assert after("near_dedup") - after("decontamination") == {204}
    assert after("packing") == after("decontamination") >= {200, 203, 205, 206, 207}
    kept = sorted(after("decontamination"))
    texts_kept = [out["decontamination"][i]["text"] for i in kept]
    renumber = {d: k for k, d in enumerate(kept)}
    check_packing([{**p.asDict(), "doc_id": renumber[p["doc_id"]]} for p in stage.collect()], texts_kept, 4096)
    assert corpus_pipeline.run(spark, sf).count() == stage.count()


def test_sample_stays_within_its_limits_when_ids_repeat(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "other"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 1), (3, 0)], "doc_id long, toxic int")
    got = toxicity.draw_sample(docs, labels, max_toxic=1, max_clean=1).collect()
    assert len(got) <= 2 and {(r["doc_id"], r["toxic"]) for r in got} <= {(1, 1), (2, 0), (3, 0)}
    assert [r["text"] for r in got if r["doc_id"] == 1] == ["text 0"]


def most_bytes(work):
    """The most that numpy and Python hold at a time while ``work`` runs."""
    import tracemalloc
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_tagger_fit_and_scores_need_little_memory_a_token():
    import pyarrow as pa
    words = [f"word{i:03d}" for i in range(997)]
    texts = [" ".join(words[(k * 31 + j * j) % 997] for j in range(400)) for k in range(1500)]  # 600,000 tokens, 4.8 MB
    toxic = np.arange(len(texts)) % 3 == 0
    tables = 24 << 20  # weights and their steps
    assert most_bytes(lambda: toxicity.fit(texts, toxic, rounds=2)) <= tables + 96 * 600_000
    column = pa.array(texts * 4)
    batch = pa.record_batch([pa.array(range(len(column))), column], ["doc_id", "text"])
    scores = toxicity._scorer(toxicity.Model(), False)
    assert most_bytes(lambda: sum(b.num_rows for b in scores([batch]))) <= 28 << 20


def test_more_templates_than_one_pass_takes(make, monkeypatch):
    texts = [prose(40, 20) + " " + licenses.TEMPLATES[n] + " " + prose(41, 20) for n in sorted(licenses.TEMPLATES)]
    docs = make(texts)
    one = sorted(map(tuple, licenses.scan(docs).collect()))
    monkeypatch.setattr(licenses, "MAX_KEYS", 30)
    assert sorted(map(tuple, licenses.scan(docs).collect())) == one and len(one) >= len(texts)
