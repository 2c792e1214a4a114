"""Texts and rows that the tests of this folder share."""
import random

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so", "ta", "vi") for b in ("n", "ra", "st", "lem", "dor", "wyx")]


def prose(seed: int, n: int, per_line: int = 12) -> str:
    rng = random.Random(seed)
    words = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + per_line]) for i in range(0, n, per_line))


#: Column names that operators use inside.
CLASHES = ["value", "component", "sketch", "core", "start", "n", "digest", "keep_id", "shard", "row_index",
           "packed", "doc", "leader", "cut", "n_lines", "_cut", "score", "spans", "_source", "_m", "_row"]


def messy_rows():
    base = prose(1, 300)
    return [
        (1, base, "src0"), (2, base, "src0"), (2, base, "src0"), (3, base.upper(), "src1"),
        (4, base + "\n" + prose(2, 20), None), (5, None, "src0"), (6, "", "src0"), (7, " \n\t ", "src2"),
        (8, "word", "src2"), (9, "word", None), (10, prose(3, 20_000), "src0"), (None, prose(4, 60), "src0"),
        (None, None, None), (11, "a b c", "src0"), (12, "é ñ ß 漢字 \x01 it's 3.5% <|endoftext|>", "src1"),
        (13, "same same same same same same same same same same", "src0"), (14, prose(5, 80), "src0"),
    ]


def documents(spark, texts, source="s"):
    """A table of documents with ids 0.. in the order of ``texts``."""
    return spark.createDataFrame([(i, t, source) for i, t in enumerate(texts)],
                                 "doc_id long, text string, source string")
