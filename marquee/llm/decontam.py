"""Benchmark decontamination by SimHash over item-sized windows.

Every benchmark item has a 64-bit SimHash of its weighted word shingles.
Documents are read in windows of the items' sizes, at every offset; windows
without any shingle of the benchmark have similarity 0 and need no
fingerprint.  Fingerprints are looked up in a multi-index: 64 bits are four
blocks of 16, and of two fingerprints at most ``4 * block_radius + 3`` bits
apart one block is at most ``block_radius`` apart, so an index of all block
values that near to an item's finds every item within that radius.  What it
finds is verified by the exact weighted similarity of the shingle sets.

A window meets the items of its own number of words.  Weights come from how many
of all items have a shingle, so what is found does not depend on the blocks:
items are the stated queries, they are taken in blocks of bounded size, one
block at a time lies on the driver, and each meets all documents in one pass
without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (NOT_ALNUM, fold_case, materialize, prefix_sums, range_hash, shingle_hashes, slices,
                     text_buffer, word_spans)

#: Items and bytes of text of one block, on average: bound the index in each task and what the driver holds.
BLOCK_ITEMS, BLOCK_BYTES = 2000, 8 << 20
#: Weights are whole numbers of sixteenths, so that sums over windows are exact.
UNIT = 16
_BITS = np.arange(64, dtype=np.uint64)


def _words(flat: np.ndarray, offsets: np.ndarray):
    """Case-folded words without punctuation: hashes, starts, ends, first of each row."""
    starts, ends, first = word_spans(flat, offsets, NOT_ALNUM)
    return range_hash(prefix_sums(fold_case(flat)), starts, ends), starts, ends, first


def _signs(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """[shingles, 64]: plus or minus the weight by the bits of the hash."""
    bits = (hashes[:, None] >> _BITS & np.uint64(1)).astype(np.int32)
    return (2 * bits - 1) * weights[:, None].astype(np.int32)


def _fold(sums: np.ndarray) -> np.ndarray:
    """Fingerprints: bit j is set where the j-th sum is positive."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


class Items:
    """A block of benchmark items of one shingle width, with the multi-index of their fingerprints.

    Where the block is not the whole benchmark, ``total`` is the number of all
    items and ``counts`` has the block's shingles and how many of all items have them.
    """

    def __init__(self, ids: np.ndarray, texts: list[str], width: int, block_radius: int, total: int | None = None,
                 counts: tuple[np.ndarray, np.ndarray] | None = None):
        total = len(texts) if total is None else total
        flat, offsets = text_buffer(pa.array(texts, pa.large_string()))
        words, _, _, first = _words(flat, offsets)
        shingles, begin = shingle_hashes(words, first, width)
        row = np.repeat(np.arange(len(texts)), np.diff(begin))
        pair = np.unique(np.stack([row.astype(np.uint64), shingles]), axis=1)
        self.width, self.ids, self.sizes = width, ids, np.diff(first)
        self.shingles, count = np.unique(pair[1], return_counts=True)
        if counts is not None:
            count = counts[1][np.searchsorted(counts[0], self.shingles)]
        # Shingles of few items weigh more; those of none weigh like those of one.
        self.top = int(round(UNIT * (1 + np.log(max(total, 1)))))
        self.weights = np.round(UNIT * (1 + np.log(total / count))).astype(np.int64)
        at = np.searchsorted(self.shingles, pair[1])
        item = pair[0].astype(np.int64)
        self.member = item * len(self.shingles) + at  # sorted: unique() sorts by row, then hash
        self.member.sort()
        self.mass = np.bincount(item, self.weights[at], len(texts)).astype(np.int64)
        self.prints = np.zeros(len(texts), np.uint64)
        for i in range(len(texts)):
            own = at[item == i]
            if len(own):
                self.prints[i] = _fold(_signs(self.shingles[own], self.weights[own]).sum(0)[None])[0]
        self.radius = 4 * block_radius + 3
        near = np.array([sum(1 << b for b in c) for r in range(block_radius + 1)
                         for c in combinations(range(16), r)], np.uint16)
        self.index = []
        for b in range(4):
            keys = ((self.prints >> np.uint64(16 * b)).astype(np.uint16)[:, None] ^ near).ravel()
            who = np.repeat(np.arange(len(texts)), len(near))
            order = np.argsort(keys, kind="stable")
            self.index.append((np.searchsorted(keys[order], np.arange(65537)), who[order]))

    def lookup(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius."""
        found = []
        for b, (begin, who) in enumerate(self.index):
            key = (prints >> np.uint64(16 * b)).astype(np.uint16).astype(np.int64)
            n = begin[key + 1] - begin[key]
            window = np.repeat(np.arange(len(prints)), n)
            upto = np.concatenate([[0], np.cumsum(n)])
            item = who[np.arange(upto[-1]) - upto[window] + begin[key][window]]
            gap = np.bitwise_count(prints[window] ^ self.prints[item])
            near = gap <= self.radius
            found.append(np.stack([window[near], item[near], gap[near]]))
        w, i, d = np.unique(np.concatenate(found, 1), axis=1)
        return w, i, d


#: Windows that are fingerprinted at once in a task.
STEP = 16384


def search(items: Items, flat: np.ndarray, offsets: np.ndarray, percent: int) -> list[tuple]:
    """Best window of each (row, item) that is similar enough: (row, item, similarity, distance, byte range)."""
    words, starts, ends, first = _words(flat, offsets)
    width = items.width
    n = len(words) - width + 1
    if n <= 0 or not len(items.shingles):
        return []
    shingles = shingle_hashes(words, np.array([0, len(words)]), width)[0]
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = row[:n] == row[width - 1:]  # the shingle lies in one row
    at = np.minimum(np.searchsorted(items.shingles, shingles), len(items.shingles) - 1)
    hit = (items.shingles[at] == shingles) & inside
    if not hit.any():
        return []
    hits = np.concatenate([[0], np.cumsum(hit)])
    # Only places within reach of a hit matter; the rest is left out of the sums.
    longest = int(items.sizes.max())
    near = np.zeros(n + 1, np.int64)
    place = np.flatnonzero(hit)
    np.add.at(near, np.maximum(place - longest, 0), 1)
    np.add.at(near, np.minimum(place + longest + 1, n), -1)
    kept = np.flatnonzero(np.cumsum(near[:n]) > 0)
    local = np.full(n + 1, -1, np.int64)
    local[kept] = np.arange(len(kept))
    weight = np.where(hit, items.weights[at], items.top)[kept]
    out: dict[tuple[int, int], tuple] = {}
    for size in np.unique(items.sizes):
        span = int(size) - width + 1  # shingles of a window
        if span < 1:
            continue
        s = kept[kept + span <= n]
        s = s[(row[s] == row[s + size - 1]) & (hits[s + span] > hits[s])]
        for cut in range(0, len(s), STEP):
            _windows(items, s[cut:cut + STEP], span, local, kept, shingles, at, hit, weight, percent, row,
                     starts, ends, out)
    return [(r, int(items.ids[i]), *v) for (r, i), v in sorted(out.items())]


def _windows(items, s, span, local, kept, shingles, at, hit, weight, percent, row, starts, ends, out) -> None:
    """Fingerprint windows of ``span`` shingles at places ``s``, look them up, verify what is found."""
    lo = local[s[0]]
    hi = local[s[-1] + span - 1] + 1
    total = np.zeros((hi - lo + 1, 64), np.int32)
    np.cumsum(_signs(shingles[kept[lo:hi]], weight[lo:hi]), axis=0, out=total[1:])
    a = local[s] - lo
    w, item, gap = items.lookup(_fold(total[a + span] - total[a]))
    mine = items.sizes[item] == span + items.width - 1  # items of the window's size
    w, item, gap = w[mine], item[mine], gap[mine]
    if not len(w):
        return
    spot = s[w][:, None] + np.arange(span)  # places of each window's shingles
    own = shingles[spot]
    order = np.argsort(own, axis=1, kind="stable")
    ranked = np.take_along_axis(own, order, 1)
    new = np.ones(ranked.shape, bool)
    new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    once = np.empty_like(new)
    np.put_along_axis(once, order, new, 1)  # the first of equal shingles
    mass = np.where(once, weight[local[spot]], 0)
    member = item[:, None] * len(items.shingles) + at[spot]
    where = np.minimum(np.searchsorted(items.member, member), len(items.member) - 1)
    common = np.where(hit[spot] & (items.member[where] == member), mass, 0).sum(1)
    union = mass.sum(1) + items.mass[item] - common
    for k in np.flatnonzero(100 * common >= percent * union):
        place = s[w[k]]
        r = int(row[place])
        found = (float(common[k] / union[k]), int(gap[k]), int(starts[place]),
                 int(ends[place + span + items.width - 2]))
        key = (r, int(item[k]))
        if key not in out or (-found[0], found[2], found[3]) < (-out[key][0], out[key][2], out[key][3]):
            out[key] = found


def _searcher(ids: list[int], texts: list[str], width: int, percent: int, block_radius: int, total: int, counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _by_width(np.array(ids, np.int64), texts, width, block_radius, total, counts)
        for b in batches:
            doc_ids = b.column(0)
            flat, offsets = text_buffer(b.column(1))
            rows: list[tuple] = []
            for lo, hi in slices(offsets):
                part, offs = flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                for items in blocks:
                    rows += [(lo + r, i, x, d, s - int(offs[r]), e - int(offs[r]))
                             for r, i, x, d, s, e in search(items, part, offs, percent)]
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.record_batch(
                [doc_ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int32()),
                 pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64())],
                ["doc_id", "item_id", "similarity", "distance", "byte_start", "byte_end"])

    return run


def _widths(texts: list[str], width: int) -> np.ndarray:
    """Shingle width of each text: items shorter than ``width`` words are one shingle of their own length."""
    flat, offsets = text_buffer(pa.array(texts, pa.large_string()))
    return np.minimum(np.diff(_words(flat, offsets)[3]), width)


def _by_width(ids: np.ndarray, texts: list[str], width: int, block_radius: int, total: int, counts) -> list[Items]:
    own = _widths(texts, width)
    return [Items(ids[own == w], [t for t, n in zip(texts, own) if n == w], int(w), block_radius, total,
                  counts and counts[int(w)])
            for w in np.unique(own) if w]


def _item_shingles(width: int):
    """Rows (block, text) to a row for each of an item's shingles: (block, width, shingle)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            own, blocks = _widths(texts, width), np.asarray(b.column(0))
            for w in np.unique(own):
                if w:
                    at = np.flatnonzero(own == w)
                    flat, offsets = text_buffer(pa.array([texts[i] for i in at], pa.large_string()))
                    words, _, _, first = _words(flat, offsets)
                    shingles, begin = shingle_hashes(words, first, int(w))
                    row = np.repeat(np.arange(len(at)), np.diff(begin))
                    pair = np.unique(np.stack([row.astype(np.uint64), shingles]), axis=1)
                    yield pa.record_batch(
                        [pa.array(blocks[at][pair[0].astype(np.int64)].astype(np.int64)),
                         pa.array(np.full(pair.shape[1], w, np.int32)), pa.array(pair[1].view(np.int64))],
                        names=["block", "width", "shingle"])
    return run


FOUND = "doc_id long, item_id long, similarity double, distance int, byte_start long, byte_end long"


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 5, percent: int = 80,
                 block_radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it.

    Columns: doc_id, item_id, similarity (weighted Jaccard of the item and the
    best window of as many words, at least ``percent`` / 100), distance (bits
    between their fingerprints), byte_start and byte_end of that window in the
    text's UTF-8.  Weights: 1 + log of all items over those with the shingle, in
    sixteenths; a shingle of no item weighs like one of a single item.

    Defined cases: null and empty texts, and items without words, match
    nothing (they count as no items); items shorter than ``width`` words are one
    shingle; a null item_id is left out; items that repeat are items each, found
    each under their id; repeated rows and null doc_ids are searched like others;
    an empty table on either side gives no rows; further columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.filter(F.col("text").rlike(r"[^\x00-\x2F:-@\[-`{-\x7F]"))  # with a word
    total, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if not total:
        return rows.sparkSession.createDataFrame([], FOUND)
    blocks = max(1, -(-total // BLOCK_ITEMS), -(-size // BLOCK_BYTES))

    def one(b: int, counts) -> DataFrame:
        own = numbered.filter(F.col("block") == b).orderBy("item_id", "text").collect()
        return rows.mapInArrow(_searcher([r["item_id"] for r in own], [r["text"] for r in own], width, percent,
                                         block_radius, total, counts), FOUND)

    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("long"))
    if blocks == 1:
        return one(0, None)
    # How many of all items have a shingle; a block's own are fetched with the block.
    listed = materialize(numbered.select("block", "text").mapInArrow(_item_shingles(width),
                                                                     "block long, width int, shingle long"), "shingles")
    counted = materialize(listed.groupBy("width", "shingle").agg(F.count(F.lit(1)).alias("n")), "shingle-counts")
    out = None
    for b in range(blocks):
        table = (listed.filter(F.col("block") == b).select("width", "shingle").distinct()
                       .join(counted, ["width", "shingle"]).toArrow())
        w, shingle, n = (np.asarray(table.column(c)) for c in ("width", "shingle", "n"))
        counts = {}
        for k in np.unique(w):
            own = shingle[w == k].view(np.uint64)
            order = np.argsort(own)
            counts[int(k)] = (own[order], n[w == k][order])
        found = materialize(one(b, counts), "found")  # so that the driver holds one block at a time
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; a null id cannot be rejected."""
    found = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    # Written, so that its size is known when the join is planned: a short list is broadcast and no text is shuffled.
    bad = materialize(found.select(F.col("doc_id").alias("bad")).distinct(), "bad-ids")
    return docs.join(bad, docs[id_col].cast("long") == bad["bad"], "left_anti")
