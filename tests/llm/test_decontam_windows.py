"""Decontamination against every window, items edited to about 0.8, and any size of blocks."""
import random
import re
from collections import Counter
from math import log

import pytest

from llm_rows import prose
from marquee.llm import decontam


def words_of(text):
    return re.findall(r"[^\x00-\x2F:-@\[-`{-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(words, width):
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def every_window(docs, items, width=5, percent=80):
    """{(doc, item): best similarity} by the exact weighted Jaccard of every window of the item's size."""
    known = [(i, words_of(t)) for i, t in items if i is not None and words_of(t)]
    total, own, count = len(known), [], Counter()
    for i, w in known:
        k = min(width, len(w))
        own.append((i, len(w), k, shingles(w, k)))
        count.update((k, s) for s in own[-1][3])
    weight = lambda k, s: round(16 * (1 + log(total / max(count[k, s], 1))))
    out = {}
    for d, text in docs:
        words = words_of(text)
        for i, size, k, mine in own:
            for a in range(len(words) - size + 1):
                have = shingles(words[a:a + size], k)
                if have & mine:
                    common = sum(weight(k, s) for s in have & mine)
                    union = sum(weight(k, s) for s in have | mine)
                    if 100 * common >= percent * union:
                        out[d, i] = max(out.get((d, i), 0), common / union)
    return out


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = "changed" + str(rng.randrange(1000))
    return " ".join(words)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(11)
    items = [(k, prose(700 + k, rng.choice([40, 120, 160]))) for k in range(30)]
    items += [(30, items[0][1]), (31, items[1][1] + " " + items[2][1]), (32, "two words"), (33, None), (None, "no id"), (34, "--")]
    docs = []
    for k in range(60):
        text = edited(rng, items[k % 30][1], k % 4)
        docs.append((k, prose(900 + k, 30) + "\n" + text + "\n" + prose(960 + k, 30)))
    docs += [(100 + k, prose(1100 + k, 120)) for k in range(20)] + [(200, None), (201, ""), (202, "x two words x")]
    return docs, items


def test_windows_against_brute_force(spark, planted):
    docs, items = planted
    want = every_window(docs, items)
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in got}
    assert set(found) <= set(want)  # what is reported is so, exactly
    assert all(abs(found[p] - want[p]) < 1e-9 for p in found if want[p] == 1)
    assert all(found[p] <= want[p] + 1e-9 for p in found)
    # Recall over pairs of 0.8 to 1, most of them edited: the radius misses some.
    part = [p for p in want if want[p] < 0.999]
    assert len(part) >= 20 and all(p in found for p in want if want[p] >= 0.999)
    assert sum(p in found for p in part) >= 0.9 * len(part), (len(part), sum(p in found for p in part))


def test_blocks_of_any_size_find_the_same(spark, planted, monkeypatch):
    docs, items = planted
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontam.contaminated(d, i).collect()))
    for limit in (("BLOCK_ITEMS", 7), ("BLOCK_BYTES", 3000)):
        with monkeypatch.context() as m:
            m.setattr(decontam, *limit)
            assert sorted(map(tuple, decontam.contaminated(d, i).collect())) == whole
