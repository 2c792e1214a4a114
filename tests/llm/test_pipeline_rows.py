"""The pipeline's middle stages against plain Python, with null and repeated ids; and with empty tables."""
import random

import corpus_pipeline
from llm_rows import prose
from test_decontam_windows import every_window

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


def shingle_set(text, width=5):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    return {tuple(words[i:i + width]) for i in range(max(len(words) - width + 1, min(len(words), 1)))}


def plain_near_dedup(rows):
    """Rows that stay: no earlier named row is reachable by links of 0.8; copies of a row without an id of its own count once."""
    ids = [i for i, _ in rows]
    own = [i is not None and ids.count(i) == 1 for i in ids]
    once = [r for k, r in enumerate(rows) if own[k] or rows.index(r) == k]
    sets = [shingle_set(t) for _, t in once]
    group = list(range(len(once)))
    for a in range(len(once)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = group[a], group[b]
                group = [min(x, y) if g in (x, y) else g for g in group]
    return once, group


def test_near_dedup_and_decontamination_with_any_ids(spark, tmp_path):
    rng = random.Random(3)
    base = [prose(1500 + k, 80) for k in range(12)]
    near = [" ".join("new" if j == 40 else w for j, w in enumerate(t.split())) for t in base]
    item = prose(1600, 40)
    rows = [(k, t) for k, t in enumerate(base)] + [(100 + k, near[k]) for k in range(4)]
    rows += [(None, base[4]), (None, prose(1700, 70)), (None, prose(1700, 70)), (None, None), (None, "")]
    rows += [(7, near[6]), (50, prose(1701, 60)), (50, prose(1702, 60)), (50, prose(1702, 60)), (50, base[8])]
    rows += [(60, prose(1703, 30) + " " + item), (None, item + " " + prose(1704, 30)), (61, None)]
    rng.shuffle(rows)
    once, group = plain_near_dedup(rows)
    out = corpus_pipeline.drop_near_duplicates(spark, table(spark, rows).repartition(3), str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    # One row of each group stays, rows without words all.
    at = {r: k for k, r in enumerate(once)}
    assert len(kept) == len(set(kept)) and set(kept) <= set(once)
    assert sorted(group[at[r]] for r in kept) == sorted(set(group))
    # Of rows whose ids tell them apart the smallest stays.
    assert {(k, base[k]) for k in (0, 1, 2, 3)} <= set(kept) and not {(100 + k, near[k]) for k in range(4)} & set(kept)

    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    after = corpus_pipeline.drop_benchmark(spark, table(spark, rows), str(tmp_path)).collect()
    bad = {d for d, _ in every_window(list(enumerate(t for _, t in once)), [(1, item)])}
    assert len(bad) == 2
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in after))) == sorted(
        str(r) for k, r in enumerate(once) if k not in bad)


def test_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    table(spark, []).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).collect() == []
