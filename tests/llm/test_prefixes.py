"""The prefix trie of conversations against a plain one, over bands, blocks, copies and messy rows."""
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import CLASHES
from marquee.llm import prefixes

DDL = "conv_id long, turn long, role string, text string"


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small inputs keep all their partitions, so that sums and spines cross their borders."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def plain_trie(rows, span=100, most=6):
    """Every node of the rebuilt conversations, by dictionaries."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest()), (role, text)))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        whole[c] = own.get(int(c / span) * span, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, convs in members.items():
        leaf, gain = kids[node] == 0, (len(convs) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += leaf
            saved[node[:d]] += gain
    return sorted(
        ((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), kids[node], leaves[node], saved[node],
          hashlib.sha256(",".join(str(c) for c in convs if len(whole[c]) == len(node)).encode()).hexdigest())
         for node, convs in members.items()), key=str)


def got(df, **named):
    return sorted((tuple(r) for r in prefixes.conversation_trie(df, **named).collect()), key=str)


def grown(rng, n, lengths, kinds=3):
    """Conversations that share beginnings."""
    rows, made = [], []
    for c in range(n):
        old = rng.choice(made) if made and rng.random() < 0.7 else []
        turns = old[:rng.randrange(len(old) + 1)]
        while len(turns) < rng.choice(lengths):
            turns = turns + [(rng.choice(["user", "bot"]), f"t{rng.randrange(kinds)}" * rng.randrange(1, 4))]
        made.append(turns)
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    return rows


def test_trie_equals_a_plain_one(spark):
    rows = grown(random.Random(1), 300, [1, 3, 5, 9])
    assert got(spark.createDataFrame(rows, DDL).repartition(7)) == plain_trie(rows)


def test_long_conversations_cross_bands(spark):
    band = prefixes.BAND
    rows = grown(random.Random(2), 40, [band - 1, band, band + 1, 2 * band, 5 * band + 3], kinds=2)
    same = [(1000 + c, i, "user", f"w{i % 3}") for c in range(30) for i in range(4 * band + 7)]  # copies
    fork = [(2000 + c, i, "user", f"w{i % 3}" if i < 2 * band + c % 3 else f"f{c}") for c in range(6)
            for i in range(3 * band)]
    rows += same + fork
    assert got(spark.createDataFrame(rows, DDL), most=1) == plain_trie(rows, most=1)
    assert got(spark.createDataFrame(rows, DDL)) == plain_trie(rows)


def test_one_conversation_with_a_third_of_all_rows_lies_in_many_partitions(spark):
    rows = [(c, i, "user", f"{c} {i}") for c in range(60) for i in range(20)] + [(7, 50 + i, "bot", f"{i}") for i in range(600)]
    assert got(spark.createDataFrame(rows, DDL).repartition(5)) == plain_trie(rows)
    df = spark.createDataFrame(rows, DDL).withColumn("one", F.lit(1).cast("long"))
    sums = prefixes.running_sums(df.repartition(5), "conv_id", ["conv_id", "turn"], ["one"], "test")
    assert sorted(r["before_one"] for r in sums.filter("conv_id = 7").collect()) == list(range(620))
    assert len({r["p"] for r in df.repartitionByRange("conv_id", "turn").filter("conv_id = 7")
                .select(F.spark_partition_id().alias("p")).distinct().collect()}) > 1


def test_trie_messy(spark):
    rows = [(0, 1, "user", "a"), (0, None, "user", "first"), (0, 1, "user", "a"), (0, 1, None, "b"), (1, 0, "user", None),
            (1, 0, None, None), (None, 0, "user", "lost"), (2, 5, "user", "é漢😀"), (3, 1, "user", ""), (300, 0, "x", "y"),
            (-5, 0, "user", "a"), (-5, 1, "user", "long " * 5000), (104, 0, "user", "q"), (105, 0, "user", "q"), (107, 3, "z", "")]
    df = spark.createDataFrame(rows, DDL)
    df = df.select("*", *[F.lit("x").alias(c) for c in [*CLASHES, "place", "digest", "name", "band"] if c not in df.columns])
    assert got(df) == plain_trie(rows)
    assert got(df.limit(0)) == []
    assert got(df.filter("conv_id IS NULL")) == []


def test_findclose():
    rng = random.Random(5)
    for _ in range(60):
        opens, depth = [], 0
        for _ in range(rng.choice([1, 5, 100, 700])):
            if depth == 0 or rng.random() < rng.choice([0.3, 0.5, 0.9]):
                opens.append(True)
                depth += 1
            else:
                opens.append(False)
                depth -= 1
        opens += [False] * depth
        stack, want = [], {}
        for i, o in enumerate(opens):
            if o:
                stack.append(i)
            else:
                want[stack.pop()] = i
        place = np.flatnonzero(opens)
        assert prefixes.Parentheses(np.array(opens)).findclose(place).tolist() == [want[p] for p in place.tolist()]
