"""Near-duplicates by bottom-k sketches from one hash function.

A document is its set of distinct word shingles; its sketch is the ``k``
smallest shingle hashes.  Equal sets are collapsed to one representative.
Inverted lists from retained values to representatives generate overlaps:

* Of two sets with Jaccard similarity at least s, the union's sketch has at
  least ``need(k)`` = s k - 5 standard deviations values that both retain
  (missed with a probability of at most 1.2e-6 at 0.8 and k = 32; exactly s n if the sets are smaller
  than the sketch).  Both therefore share a value among all but ``need - 1``
  of their values in any common order.  Values are ordered from rare to
  frequent, so values found everywhere head no list unless a document has
  nothing else, and a value found once uses up a place at no cost.
* Within a list each member is first compared with one leader, the member
  whose values are the most frequent of all (a base text rather than an
  edited copy): union sketches estimate the similarity, and what may reach
  the threshold is compared by full sets.  That joins a large group of copies
  with one comparison each, and settles most lists.
* The lists of a leader whose members are still in several components make a
  cell.  A cell is split into blocks of bounded size, every pair of blocks is
  a group of its own, and a group compares full sets by matrix products and
  returns only links that join two components.  So a hot group costs
  comparisons, spread over tasks, but never rows for all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (as_signed, list_array, materialize, mix, shingle_hashes, slices, text_buffer,
                     word_hashes)
from .graph import components


def need(k: int, similarity: float) -> int:
    """Values of a union's sketch of ``k`` that both sets retain, but for odds of about 1e-6."""
    return max(1, math.floor(k * similarity - 5 * math.sqrt(k * similarity * (1 - similarity))))


def _sets(flat, offsets, width):
    """(sorted distinct shingles of all rows, begin of each row's)."""
    words, first = word_hashes(flat, offsets)
    shingles, begin = shingle_hashes(words, first, width)
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((shingles, row))
    shingles, row = shingles[order], row[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (shingles[1:] != shingles[:-1]) | (row[1:] != row[:-1])
    shingles, row = shingles[keep], row[keep]
    return shingles, np.searchsorted(row, np.arange(len(begin)))


def _sketcher(width: int, k: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, offsets = text_buffer(b.column(1))
            for lo, hi in slices(offsets):
                s, begin = _sets(flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], width)
                size = np.diff(begin)
                row = np.repeat(np.arange(hi - lo), size)
                rank = np.arange(len(s)) - begin[:-1][row] if len(s) else np.zeros(0, np.int64)
                low = rank < k  # shingles are sorted by hash within their row
                upto = np.concatenate([[0], np.cumsum(np.minimum(size, k))])
                # A 128-bit digest of the set: sums of two further hashes of its members.
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(s ^ np.uint64(c)))]) for c in (0xA5A5, 0x3C3C3C)]
                digest = [as_signed(mix(x[begin[1:]] - x[begin[:-1]])) for x in sums]
                yield pa.record_batch(
                    [b.column(0).slice(lo, hi - lo), pa.array(size), pa.array(digest[0]), pa.array(digest[1]),
                     list_array(as_signed(s[low] ^ np.uint64(1 << 63)), upto, pa.int64())],
                    ["doc_id", "n_shingles", "set_a", "set_b", "sketch"])

    return sketch


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd frames, so that shuffles move a third of the bytes."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3)
    for b in batches:
        texts = b.column(1).cast(pa.large_binary())
        packed = pa.array([pack.compress(x.as_py() or b"") for x in texts], pa.binary())
        yield pa.record_batch([b.column(0), packed], ["doc_id", "packed"])


def _verifier(width: int, percent: int):
    """Rows (a, b, packed_a, packed_b) whose full sets have 100 |a & b| >= percent |a | b|."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        last: tuple = (None, None)

        def load(data: bytes) -> np.ndarray:
            flat = np.frombuffer(unpack.decompress(data), np.uint8)
            return _sets(flat, np.array([0, len(flat)]), width)[0]

        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                y = y.as_py()
                if last[0] != y:  # rows come sorted by b
                    last = (y, load(y))
                mine = load(x.as_py())
                both = np.concatenate([mine, last[1]])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= percent * (len(both) - common))
            keep = pa.array(ok, pa.bool_())
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    return verify


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = 32,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Linked documents have 100 |intersection| >= ``percent`` |union| of their
    ``width``-word shingle sets; ``component_id`` is the smallest doc_id
    reachable by links, itself included; ``kept`` marks that document.

    Defined cases: a null or empty text has an empty set and links with
    nothing; with fewer words than ``width`` the whole sequence is the one
    shingle; documents with equal sets link; a row with a null id takes the
    component of its set, and has none (null) if no other row has the set;
    repeated rows share an id and hence a component; an empty table gives no
    rows; further columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sigs = materialize(rows.mapInArrow(
        _sketcher(width, k),
        "doc_id long, n_shingles long, set_a long, set_b long, sketch array<long>"), "sketches")
    classes = (sigs.filter("n_shingles > 0").groupBy("set_a", "set_b")
                   .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                        F.first("sketch").alias("sketch")))
    reps = materialize(classes, "classes")
    links = _links(rows, reps.filter("rep IS NOT NULL"), width, percent, k)
    found = components(links)
    named = (reps.select("set_a", "set_b", "rep")
                 .join(found, reps["rep"] == found["node"], "left")
                 .select("set_a", "set_b", F.coalesce("component", "rep").alias("_component")))
    linked = (sigs.filter("n_shingles > 0").select("doc_id", "n_shingles", "set_a", "set_b")
                  .join(named, ["set_a", "set_b"]).select("doc_id", "n_shingles", "_component"))
    alone = sigs.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("_component"))
    return linked.union(alone).select(
        "doc_id", "n_shingles", F.col("_component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("_component")).alias("kept"))


def _postings(reps: DataFrame, percent: int, k: int) -> DataFrame:
    """(value, doc, n, weight): the rarest values by which a document must meet its partners."""
    values = reps.select(F.col("rep").alias("doc"), "n", F.size("sketch").alias("kept_values"),
                         F.explode("sketch").alias("value"))
    # Written before it is joined: a join of two plain tables may split a value of very many documents.
    common = materialize(reps.select(F.explode("sketch").alias("value")).groupBy("value")
                             .agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "value-counts")
    t = need(k, percent / 100)
    # Smaller sets are whole in their sketch: percent of the larger set must be shared.
    least = F.least(F.lit(t), F.ceil(F.col("n") * percent / 100)).cast("int")
    shared = (values.join(common, "value")
                    .groupBy("doc", "n", "kept_values")
                    .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"),
                         F.sum(F.log("df")).alias("weight")))
    # Of kept_values - least + 1 places the values found once take theirs first.
    places = F.size("shared") - least + 1
    return (shared.filter(places > 0)
                  .select("doc", "n", "weight", F.explode(F.slice("shared", F.lit(1), places)).alias("v"))
                  .select(F.col("v.value").alias("value"), "doc", "n", "weight"))


#: Documents, and bytes of packed text, of one block of a cell.
BLOCK_DOCS, BLOCK_BYTES = 256, 1 << 19


def _links(rows: DataFrame, reps: DataFrame, width: int, percent: int, k: int) -> DataFrame:
    """Verified links (a, b) between representatives, enough to join all that any link joins."""
    lists = materialize(_postings(reps, percent, k), "lists")
    texts = materialize(
        rows.filter("doc_id IS NOT NULL").mapInArrow(_shrink, "doc_id long, packed binary")
            .join(lists.select("doc").distinct(), F.col("doc_id") == F.col("doc"), "left_semi"), "texts")
    # The leader of a list is its most central member.
    # (Written before it is joined: a join of two plain tables may split a hot list.)
    lead = materialize(
        lists.groupBy("value")
             .agg(F.max(F.struct("weight", "doc", "n")).alias("_m"), F.count(F.lit(1)).alias("_c"))
             .filter("_c > 1").select("value", F.col("_m.doc").alias("leader"), F.col("_m.n").alias("leader_n")),
        "leaders")
    led = materialize(lists.join(lead, "value").select("leader", "leader_n", "doc", "n").distinct(), "led")
    alike = 100 * F.least("n", "leader_n") >= percent * F.greatest("n", "leader_n")
    pairs = materialize(led.filter((F.col("doc") != F.col("leader")) & alike).select(
        F.least("doc", "leader").alias("a"), F.greatest("doc", "leader").alias("b")).distinct(), "pairs")
    links = materialize(_verified(pairs, reps.select("rep", "sketch"), texts, width, percent, k), "verified")
    found = components(links)
    members = (led.select("leader", "doc").join(found, F.col("doc") == found["node"], "left")
                  .select("leader", "doc", F.coalesce("component", "doc").alias("component")))
    return links.union(_cell_links(members, texts, width, percent))


def _cell_links(members: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components within the cells (leader, doc, component), in blocks."""
    still = (members.groupBy("leader")
                    .agg(F.count(F.lit(1)).alias("_n"), F.min("component").alias("_lo"), F.max("component").alias("_hi"))
                    .filter("_lo < _hi AND _n > 2").select("leader"))  # a pair alone has been compared
    still = materialize(still, "open-cells")
    cells = materialize(members.join(still, "leader").join(texts, F.col("doc") == F.col("doc_id"))
                               .select("leader", "doc", "component", "packed"), "cells")
    sizes = materialize(cells.groupBy("leader").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum(F.length("packed")) / BLOCK_BYTES)).alias("_blocks")),
        "cell-sizes")
    own = cells.join(sizes, "leader").withColumn("_own", F.pmod(F.xxhash64("doc"), F.col("_blocks")))
    met = own.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    groups = met.select("leader", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"),
                        (F.col("_own") <= F.col("_other")).alias("left"), "doc", "component", "packed")
    return groups.groupBy("leader", "i", "j").applyInArrow(_block_links(width, percent), "a long, b long")


def _block_links(width: int, percent: int):
    """Two blocks of a cell (or one with itself): links that join components, from exact set sizes."""

    def run(table: pa.Table) -> pa.Table:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        table = table.combine_chunks()
        docs = table["doc"].to_numpy()
        comp = table["component"].to_numpy()
        texts = [unpack.decompress(x.as_py()) for x in table["packed"]]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        same = table["i"][0].as_py() == table["j"][0].as_py()
        side = np.ones(len(docs), bool) if same else table["left"].to_numpy()
        other = side if same else ~side
        sets, begins = [], [np.zeros(1, np.int64)]
        for lo, hi in slices(offsets):
            s, begin = _sets(flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], width)
            sets.append(s)
            begins.append(begins[-1][-1] + begin[1:])
        begin = np.concatenate(begins)
        size = np.diff(begin)
        common = _common(np.concatenate(sets), np.repeat(np.arange(len(docs)), size), side, other)
        total = size[side][:, None] + size[other][None]
        linked = (100 * common >= percent * (total - common)) & (comp[side][:, None] != comp[other][None])
        x, y = np.nonzero(linked)
        x, y = np.flatnonzero(side)[x], np.flatnonzero(other)[y]
        # One link for each two components, and of those a spanning forest.
        _, one = np.unique(np.stack([np.minimum(comp[x], comp[y]), np.maximum(comp[x], comp[y])]), axis=1,
                           return_index=True)
        root: dict[int, int] = {}

        def top(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        a, b = [], []
        for k in one:
            p, q = top(int(comp[x[k]])), top(int(comp[y[k]]))
            if p != q:
                root[max(p, q)] = min(p, q)
                a.append(int(docs[x[k]]))
                b.append(int(docs[y[k]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


#: Shingles that one matrix product takes at a time.
COLUMNS = 8192


def _common(values: np.ndarray, row: np.ndarray, side: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets (values, row) of ``side`` with those of ``other``."""
    left, right = np.cumsum(side) - 1, np.cumsum(other) - 1
    out = np.zeros((int(side.sum()), int(other.sum())), np.float32)
    distinct, column, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count > 1
    at = (np.cumsum(shared) - 1)[column]
    keep = shared[column]
    at, row = at[keep], row[keep]
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    for lo in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(at, [lo, lo + COLUMNS])
        c, r = at[a:b] - lo, row[a:b]
        m, w = np.zeros((out.shape[0], COLUMNS), np.float32), np.zeros((out.shape[1], COLUMNS), np.float32)
        m[left[r[side[r]]], c[side[r]]] = 1
        w[right[r[other[r]]], c[other[r]]] = 1
        out += m @ w.T
    return np.rint(out).astype(np.int64)


def _verified(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, width: int, percent: int,
              k: int) -> DataFrame:
    """The pairs whose union sketch leaves the similarity possible and whose full sets confirm it."""
    a = sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("_sa"))
    b = sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("_sb"))
    union = F.slice(F.sort_array(F.array_union("_sa", "_sb")), 1, k)
    common = F.size(F.array_intersect(F.array_intersect(union, "_sa"), F.col("_sb")))
    least = F.when(F.size(union) < k, F.ceil(F.size(union) * percent / 100)).otherwise(need(k, percent / 100))
    likely = pairs.join(a, "a").join(b, "b").filter(common >= least).select("a", "b")
    ta = texts.select(F.col("doc_id").alias("a"), F.col("packed").alias("_ta"))
    tb = texts.select(F.col("doc_id").alias("b"), F.col("packed").alias("_tb"))
    rows = likely.join(ta, "a").join(tb, "b").select("a", "b", "_ta", "_tb")
    return rows.mapInArrow(_verifier(width, percent), "a long, b long").distinct()
