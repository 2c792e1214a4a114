"""Near-duplicates, exact copies, repeated substrings and lines against brute force."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from llm_rows import prose
from marquee.llm import digests, linediff, minhash, suffixes
from marquee.llm.graph import components


def words(text):
    low = re.sub(r"[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text, width):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(len(w) - width + 1, 1)))


def brute_components(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((top(i), top(j)))
                root[q] = p
    return {i: top(i) for i, _ in sets}


def edited(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, make, seed, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 16)  # cells of several blocks
    rng = random.Random(seed)
    texts = [prose(100 + k, 40, 40) for k in range(30)]
    for b in range(4):  # groups of copies with few to many edits, and copies of copies
        base = prose(b, 150, 150)
        group = [base] + [edited(rng, base, rng.randrange(0, 14)) for _ in range(40)]
        group += [edited(rng, rng.choice(group), rng.randrange(1, 5)) for _ in range(15)]
        texts += group
    texts += [texts[40].upper(), "a b", "a b", "a  b\n", "", " ", None]
    rng.shuffle(texts)
    got = minhash.near_duplicates(make(texts), width=4).collect()
    want = brute_components(list(enumerate(texts)), 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingles(t, 4)) for i, t in enumerate(texts)}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_isolated_pairs_at_the_threshold_link(make):
    """A text and its beginning, 0.8 alike, with sets larger than the sketch and up to twice its size."""
    texts = []
    for pair in range(3000):
        n = (60, 50, 45)[pair % 3]
        words_ = [f"w{pair}x{j}" for j in range(n + 3)]
        texts += [" ".join(words_), " ".join(words_[:n * 4 // 5 + 3])]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(make(texts), width=4).collect()}
    assert [i for i in got if got[i] != i - i % 2] == []


def test_near_duplicates_messy(messy, nothing):
    got = minhash.near_duplicates(messy, width=4).collect()
    assert len(got) == 17
    by = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert by[1] == by[2] == by[3] == by[4] == 1 and by[8] == by[9] == 8
    assert by[5] == 5 and by[6] == 6 and by[7] == 7
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None}
    assert minhash.near_duplicates(nothing).collect() == []


def test_block_links_span_all_components():
    """Any split of a cell into blocks yields links that join what brute force joins."""
    import pyarrow as pa
    import zstandard

    rng = random.Random(3)
    base = prose(9, 120, 120)
    texts = [edited(rng, base, rng.randrange(0, 12)) for _ in range(30)]
    pack = zstandard.ZstdCompressor()
    table = lambda ids, i, j, left: pa.table({
        "leader": [0] * len(ids), "i": [i] * len(ids), "j": [j] * len(ids), "left": left, "doc": ids,
        "component": ids, "packed": [pack.compress(texts[k].encode()) for k in ids]})
    run = minhash._block_links(4, 80)
    lo, hi = list(range(15)), list(range(15, 30))
    links = [t for x in (table(lo, 0, 0, [True] * 15), table(hi, 1, 1, [True] * 15),
                         table(lo + hi, 0, 1, [True] * 15 + [False] * 15)) for t in run(x).to_pylist()]
    root = list(range(30))
    top = lambda i: i if root[i] == i else top(root[i])
    for x in links:
        p, q = sorted((top(x["a"]), top(x["b"])))
        root[q] = p
    want = brute_components(list(enumerate(texts)), 4, 80)
    assert {i: top(i) for i in range(30)} == want


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(100, k) for k in range(101, 150)] + [(7, 7), (3, 2)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 20 for i in range(20, 61)}, **{k: 100 for k in range(100, 150)}, 2: 2, 3: 2}


def test_exact_dedup_messy(messy, nothing):
    got = digests.exact_dedup(messy).collect()
    assert len(got) == 17
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert {i: by[i]["keep_id"] for i in (1, 2, 3, 5, 6, 8, 9)} == {1: 3, 2: 3, 3: 3, 5: 6, 6: 6, 8: 9, 9: 9}
    assert by[3]["group_size"] == 4 and by[3]["kept"] and not by[1]["kept"]
    assert by[6]["group_size"] == 3  # two nulls and an empty text
    assert by[6]["text_sha256"] == hashlib.sha256(b"").hexdigest()
    assert digests.exact_dedup(nothing).collect() == []


def test_digest_index_persists_and_appends(spark, make, tmp_path):
    path = str(tmp_path / "index")
    index = digests.DigestIndex(spark, path, buckets=4)
    assert index.add(make(["a", "b", "A"])).count() == 2
    again = digests.DigestIndex(spark, path, buckets=4)  # opened from its files
    assert again.read().count() == 2
    fresh = again.add(make(["b", "c", "c"]))
    assert [r["group_size"] for r in fresh.collect()] == [2]
    assert again.read().count() == 3
    plan = make(["x"]).selectExpr("unhex(sha2(text, 256)) AS digest").join(
        again.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan


def test_later_copies_count_and_batches_meet_a_filled_index(spark, make):
    index = digests.DigestIndex(spark, buckets=4)
    index.add(make(["a", "b"]))
    index.add(make(["B", "b", "c"]))
    index.add(make(["b"]))
    assert sorted(r["group_size"] for r in index.entries().collect()) == [1, 1, 4]
    plan = index.entries()._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    texts = [f"t{i % 7}" for i in range(100)] + ["only"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "t3"), (None, "nobody"), (None, "nobody")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    before = {t.name for t in spark.catalog.listTables()}
    for batches in (1, 2, 5):
        got = digests.exact_dedup(df, batches=batches).collect()
        assert len(got) == len(rows)
        for r in got:
            same = [i for i, t in rows if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"]]
            assert r["group_size"] == len(same)
            assert r["keep_id"] == max((i for i in same if i is not None), default=None)
            assert r["kept"] == (r["doc_id"] == r["keep_id"])
    assert {t.name for t in spark.catalog.listTables()} == before  # nothing is left behind
    late = digests.exact_dedup(make(["b", "x"]), index=index).collect()
    assert sorted((r["group_size"], r["keep_id"]) for r in late) == [(1, 1), (5, 1)]
    index.drop()


# --- substrings -----------------------------------------------------------------

def brute_substrings(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = 1
        runs = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        out.append((len(d), int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[gone[:-1] == 0])))
    return out


@pytest.mark.parametrize("heavy", [suffixes.HEAVY, 3])
def test_substrings_equal_brute_force(make, heavy, monkeypatch):
    monkeypatch.setattr(suffixes, "HEAVY", heavy)  # 3: also the path of hot cores
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 700)  # texts over several slices
    rng = random.Random(5)
    passage = prose(77, 40, 40)
    texts = [prose(k, 60) for k in range(8)]
    texts += [prose(200 + k, rng.randrange(3, 40)) + " " + passage[rng.randrange(0, 60):rng.randrange(150, 300)]
              + " " + prose(300 + k, 20) for k in range(25)]
    texts += [texts[0], texts[1][10:], "ab" * 300, "x" * 500, "", None, "é" * 120, texts[2] + texts[2]]
    got = {r["doc_id"]: r for r in suffixes.substring_dedup(make(texts), length=60).collect()}
    for i, (size, removed, runs, kept) in enumerate(brute_substrings(texts, 60)):
        r = got[i]
        assert (r["n_bytes"], sum(s["hi"] - s["lo"] for s in r["removed"]), len(r["removed"])) == (size, removed, runs), i
        assert bytes(r["kept"]) == kept


def test_substrings_messy(messy, nothing):
    got = suffixes.substring_dedup(messy, length=400).collect()
    assert len(got) == 17
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert len(by[1]["kept"]) == 0 and len(by[2]["kept"]) == 0 and by[5]["n_bytes"] == 0
    assert by[10]["removed"] == [] and by[3]["removed"] == []
    assert suffixes.substring_dedup(nothing).collect() == []


def test_difference_cover_brings_all_residues_together():
    for period in (8, 40, 64):
        mask, shift = suffixes.difference_cover(period)
        for i in range(period):
            for j in range(period):
                s = shift[i, j]
                assert s < period and mask[(i + s) % period] and mask[(j + s) % period]


# --- lines ------------------------------------------------------------------------

def brute_lines(rows, min_chars):
    """First holders of each occurrence of a line by scanning documents in order, then the same alignment."""
    first, cut, table = {}, {}, {}
    for i, text in sorted(r for r in rows if r[0] is not None):
        lines = (text or "").split("\n")
        count = Counter()
        total = Counter(lines)
        pairs = {}
        for p, line in enumerate(lines):
            ink = len(re.sub(rb"[\x20\x09-\x0D]", b"", line.encode()))
            if not ink:
                continue
            key = (line, count[line])
            count[line] += 1
            if key in first and first[key][0] != i:
                j, q, once = first[key]
                pairs.setdefault(j, []).append((p, q, once and total[line] == 1, ink))
            else:
                first.setdefault(key, (i, p, total[line] == 1))
        gone = set()
        for j, shared in pairs.items():
            ink = {p: n for p, _, _, n in shared}
            for block in linediff.blocks(linediff.align([s[:3] for s in sorted(shared)])):
                if sum(ink[p] for p in block) >= min_chars:
                    gone |= set(block)
        cut[i] = gone
        table[i] = "\n".join(x for p, x in enumerate(lines) if p not in gone)
    return cut, table


def test_line_dedup_equals_brute_force(make):
    rng = random.Random(8)
    passages = [prose(500 + k, 30, 6).split("\n") for k in range(6)]
    texts = []
    for k in range(60):
        lines = prose(600 + k, rng.randrange(12, 60), 6).split("\n")
        for p in rng.sample(passages, rng.randrange(0, 3)):
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = p[rng.randrange(0, 3):]
        lines += ["menu", "", "menu"]
        texts.append("\n".join(lines))
    texts += [texts[3], texts[4] + "\n" + texts[5], "one line", "one line", "", "\n\n"]
    cut, table = brute_lines(list(enumerate(texts)), 80)
    got = {r["doc_id"]: r for r in linediff.line_dedup(make(texts)).collect()}
    assert {i: r["n_cut"] for i, r in got.items()} == {i: len(c) for i, c in cut.items()}
    assert {i: r["text"] for i, r in got.items()} == table
    assert got[60]["text"].strip("\n") in ("menu\n\nmenu", "") or got[60]["n_cut"] > 0


def test_line_dedup_messy(messy, nothing):
    out = linediff.line_dedup(messy)
    assert set(messy.columns) - {"n_lines"} <= set(out.columns)
    got = out.collect()
    assert len(got) == 17
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["n_cut"] == 0 and by[2]["text"] == "" and by[5]["text"] is None and by[5]["n_lines"] == 0
    assert by[3]["n_cut"] == 0  # compared byte by byte
    assert by[4]["n_cut"] == 25 and by[6]["text"] == "" and by[7]["text"] == " \n\t "
    assert by[1]["value"] == "x-value"
    assert linediff.line_dedup(nothing).collect() == []


def test_alignment_keeps_order():
    # B and A swapped: only one of the crossing anchors stays.
    assert len(linediff.align([(0, 5, True), (1, 6, True), (2, 7, True), (3, 0, True)])) == 3
    # A repeated line between two anchors is aligned; one outside their gap is not.
    assert linediff.align([(0, 0, True), (1, 1, False), (2, 2, True), (3, 1, False)]) == [(0, 0), (1, 1), (2, 2)]
    assert linediff.blocks([(0, 4), (1, 5), (4, 9), (5, 10)]) == [[0, 1], [4, 5]]
    assert linediff.increasing_run([]) == []


def all_pairs_cut(rows, min_chars):
    """Positions cut by patience alignment with every earlier document, each pair on all lines it shares."""
    seen, out = [], {}
    for i, text in sorted(rows):
        lines = (text or "").split("\n")
        ink = [len(re.sub(rb"[\x20\x09-\x0D]", b"", x.encode())) for x in lines]
        total, nth, mine = Counter(lines), Counter(), {}
        for p, x in enumerate(lines):
            if ink[p]:
                mine[x, nth[x]] = (p, total[x] == 1)
                nth[x] += 1
        out[i] = set()
        for theirs in seen:
            shared = sorted((p, theirs[key][0], once and theirs[key][1])
                            for key, (p, once) in mine.items() if key in theirs)
            for block in linediff.blocks(linediff.align(shared)):
                if sum(ink[p] for p in block) >= min_chars:
                    out[i] |= set(block)
        seen.append(mine)
    return out


def mixed_lines(rng, n):
    """Documents of few common and some own lines, parts of earlier documents (in another order, too) and copies."""
    common = [prose(900 + k, rng.randrange(2, 8)) for k in range(25)] + ["menu", "x", ""]
    texts = []
    for k in range(n):
        lines = [rng.choice(common) if rng.random() < 0.7 else prose(1000 + k * 50 + j, 4) for j in range(rng.randrange(1, 14))]
        if texts and rng.random() < 0.6:
            for _ in range(rng.randrange(1, 3)):
                part = rng.choice(texts).split("\n")
                a = rng.randrange(len(part))
                part = part[a:a + rng.randrange(2, 8)]
                if rng.random() < 0.3:
                    part[rng.randrange(len(part))] = "other"
                at = rng.randrange(len(lines) + 1)
                lines[at:at] = part
        texts.append(rng.choice(texts) if texts and rng.random() < 0.15 else "\n".join(lines))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup_equals_alignment_with_every_earlier_document(make, seed):
    rows = list(enumerate(mixed_lines(random.Random(seed), 250)))
    want = all_pairs_cut(rows, 80)
    got = {r["doc_id"]: r for r in linediff.line_dedup(make([t for _, t in rows]), partners="all").collect()}
    assert {i: r["n_cut"] for i, r in got.items()} == {i: len(c) for i, c in want.items()}
    assert {i: r["text"] for i, r in got.items()} == {
        i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in want[i]) for i, t in rows}


def test_copy_is_cut_whole_though_its_lines_were_first_seen_apart(make):
    a, b, c = (prose(40 + k, 5) for k in range(3))
    texts = [a, f"y\n{c}", f"{b}\nz", f"{a}\n{b}\n{c}", f"{a}\n{b}\n{c}", f"{c}\n{a}\n{b}\n{c}\nend"]
    assert max(len(x.replace(" ", "")) for x in (a, b, c)) < 80
    got = {r["doc_id"]: r for r in linediff.line_dedup(make(texts), partners="all").collect()}
    assert [got[i]["n_cut"] for i in range(6)] == [0, 0, 0, 0, 3, 2]
    assert got[4]["text"] == ""


def test_line_dedup_with_all_partners_messy(messy, nothing):
    got = linediff.line_dedup(messy, partners="all").collect()
    assert len(got) == 17
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["n_cut"] == 0 and by[2]["text"] == "" and by[5]["text"] is None and by[5]["n_lines"] == 0
    assert by[3]["n_cut"] == 0 and by[4]["n_cut"] == 25 and by[6]["text"] == "" and by[7]["text"] == " \n\t "
    assert linediff.line_dedup(nothing, partners="all").collect() == []
