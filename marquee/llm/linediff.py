"""Line de-duplication by pairwise alignment.

Shared lines (the k-th occurrence of a line in a document meets the k-th in
another) are aligned by patience diff: the rare lines of a pair, those that
occur once on either side, are anchors, of which the longest increasing run is
kept, and lines that repeat are aligned the same way between two anchors.
Aligned lines that follow each other on both sides form a block, and blocks
with enough text are deleted from the later document.  The first document
keeps its lines, so every text survives once.

``partners="all"``: a document is cut by its alignments with every earlier
document, of which only those are run that can add to the cut:

* A copy of a whole document loses all that any partner could take, so it
  meets the first copy only.
* A block holds steps: two lines that follow each other, or one line that is
  long enough.  Frequent steps that even together are too short for a block
  find no partners; every block has a step besides these.  Each such step
  proposes the first document that holds it.
* Where lines that could be in a block are still not cut, the steps there
  propose every earlier document that holds them.

``partners="first"``: each occurrence of a line points to the first document
that has as many, and a pair is aligned on the lines that point so.  A block
whose lines were first seen in several documents is split, and parts that are
too short stay.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (BASE_B, SPACE, as_signed, list_array, materialize, mix, prefix_sums, range_hash,
                     slices, text_buffer, unused)

LINES = "doc_id long, pos int, line_a long, line_b long, k int, times int, chars int"
DOC_LINES = ("doc_id long, sign_a long, sign_b long, pos array<int>, line_a array<long>, line_b array<long>, "
             "once array<boolean>, chars array<int>")
STEPS = "key long, doc_id long, pos int, apart int, chars int, next_chars int"


def _line_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with other than white space: position, 128-bit hash, which occurrence of how many."""
    for b in batches:
        flat, offsets = text_buffer(b.column(1))
        for lo, hi in slices(offsets):
            row, pos, ha, hb, k, times, chars = _lines(flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            yield pa.record_batch(
                [b.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(pos),
                 pa.array(as_signed(ha)), pa.array(as_signed(hb)), pa.array(k), pa.array(times), pa.array(chars)],
                ["doc_id", "pos", "line_a", "line_b", "k", "times", "chars"])


def _doc_lines(min_chars: int):
    """A row for each document with enough text: its lines (hashes tell occurrences apart) and a hash of them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, offsets = text_buffer(b.column(1))
            for lo, hi in slices(offsets):
                row, pos, ha, hb, k, times, chars = _lines(flat[offsets[lo]:offsets[hi]],
                                                           offsets[lo:hi + 1] - offsets[lo])
                full = np.bincount(row, chars, hi - lo) >= min_chars
                keep = full[row]
                row, pos, ha, hb, k, times, chars = (x[keep] for x in (row, pos, ha, hb, k, times, chars))
                nth = mix(k.astype(np.uint64))
                ha, hb = mix(ha ^ nth), mix(hb + nth)
                begin = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=hi - lo)[full])])
                place = mix(pos.astype(np.uint64) + np.uint64(1))
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ place))]) for h in (ha, hb)]
                signs = [pa.array(as_signed(mix(x[begin[1:]] - x[begin[:-1]]))) for x in sums]
                yield pa.record_batch(
                    [b.column(0).slice(lo, hi - lo).filter(pa.array(full)), *signs,
                     list_array(pos, begin, pa.int32()), list_array(as_signed(ha), begin, pa.int64()),
                     list_array(as_signed(hb), begin, pa.int64()), list_array(times == 1, begin, pa.bool_()),
                     list_array(chars, begin, pa.int32())],
                    ["doc_id", "sign_a", "sign_b", "pos", "line_a", "line_b", "once", "chars"])

    return run


def _lines(part: np.ndarray, offs: np.ndarray):
    """(row, pos, two hashes, k, times, chars) of the lines with other than white space, by row and position."""
    # A row with n line feeds has n + 1 lines; each ends before its feed or with its row.
    feed = np.flatnonzero(part == 10)
    row = np.concatenate([np.arange(len(offs) - 1), np.searchsorted(offs, feed, "right") - 1])
    begin = np.concatenate([offs[:-1], feed + 1])
    order = np.lexsort((begin, row))
    begin, row = begin[order], row[order]
    end = np.empty_like(begin)
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    end[last] = offs[1:][row[last]]
    end[~last] = begin[1:][~last[:-1]] - 1
    pos = np.arange(len(row)) - np.searchsorted(row, row)
    ink = np.concatenate([[0], np.cumsum(~SPACE[part])])
    chars = ink[end] - ink[begin]
    full = chars > 0
    begin, end, row, pos, chars = begin[full], end[full], row[full], pos[full], chars[full]
    ha = range_hash(prefix_sums(part), begin, end)
    hb = range_hash(prefix_sums(part, BASE_B), begin, end, BASE_B)
    order = np.lexsort((pos, ha, row))
    new = np.ones(len(order), bool)
    new[1:] = (ha[order][1:] != ha[order][:-1]) | (row[order][1:] != row[order][:-1])
    heads = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    k, times = np.empty(len(order), np.int32), np.empty(len(order), np.int32)
    if len(order):
        k[order] = np.arange(len(order)) - heads[group]
        times[order] = np.diff(np.append(heads, len(order)))[group]
    return (row, pos.astype(np.int32), mix(ha), hb, k, times, np.minimum(chars, 2**31 - 1).astype(np.int32))


def increasing_run(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, given by rising first member, whose second members rise as well."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, (_, y) in enumerate(pairs):
        j = bisect_left(tails, y)
        back.append(at[j - 1] if j else -1)
        if j == len(tails):
            tails.append(y)
            at.append(i)
        else:
            tails[j], at[j] = y, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(shared: list[tuple[int, int, bool]]) -> list[tuple[int, int]]:
    """Patience alignment of (position, other position, unique on both sides), sorted by position.

    Anchors are the unique ones; between two anchors that stay, the repeated
    lines are aligned by their own longest increasing run.
    """
    anchors = increasing_run([(x, y) for x, y, once in shared if once])
    out, rest, i = [], [s for s in shared if not s[2]], 0
    low = -1
    for x, y in [*anchors, (1 << 62, 1 << 62)]:
        gap = []
        while i < len(rest) and rest[i][0] < x:
            if low < rest[i][1] < y:
                gap.append(rest[i][:2])
            i += 1
        out += increasing_run(gap)
        out.append((x, y))
        low = y
    return out[:-1]


def blocks(aligned: list[tuple[int, int]]) -> list[list[int]]:
    """Positions of aligned lines that follow each other on both sides, by block.

    One line may stand between two of them (the same distance on both sides),
    as a blank line does; it is not part of the block.
    """
    out: list[list[int]] = []
    last = None
    for x, y in aligned:
        if last is None or x - last[0] != y - last[1] or x - last[0] > 2:
            out.append([])
        out[-1].append(x)
        last = (x, y)
    return out


def _aligner(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, cuts = [], []
            for doc, shared in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = [(r["pos"], r["other_pos"], r["once"]) for r in shared]
                size = {r["pos"]: r["chars"] for r in shared}
                gone = [x for block in blocks(align(rows)) if sum(map(size.__getitem__, block)) >= min_chars
                        for x in block]
                if gone:
                    docs.append(doc)
                    cuts.append(gone)
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(cuts, pa.list_(pa.int32()))],
                                  ["doc_id", "cut"])

    return run


def _step_table(min_chars: int):
    """Steps of documents: two lines (one may stand between them), or one line of ``min_chars`` (apart = 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            size = lists.value_lengths().to_numpy()
            row = np.repeat(np.arange(len(size)), size)
            pos, line, chars = (b.column(i).flatten().to_numpy() for i in (1, 2, 3))
            line = line.view(np.uint64)
            at, to = [np.flatnonzero(chars >= min_chars)], [np.flatnonzero(chars >= min_chars)]
            for j in (1, 2):
                near = np.flatnonzero((row[j:] == row[:-j]) & (pos[j:] - pos[:-j] <= 2))
                at.append(near)
                to.append(near + j)
            at, to = np.concatenate(at), np.concatenate(to)
            apart = pos[to] - pos[at]
            # Equal keys of other steps propose a partner in vain, no more.
            key = mix(mix(line[at] + apart.astype(np.uint64)) + np.uint64(BASE_B) * line[to])
            yield pa.record_batch(
                [pa.array(as_signed(key)), b.column(0).take(pa.array(row[at])), pa.array(pos[at]), pa.array(apart),
                 pa.array(chars[at]), pa.array(chars[to])],
                ["key", "doc_id", "pos", "apart", "chars", "next_chars"])

    return run


class _Runs:
    """Lines joined by steps, with the text that they hold together."""

    def __init__(self):
        self.up: dict[int, int] = {}
        self.chars: dict[int, int] = {}

    def top(self, x: int, chars: int) -> int:
        if x not in self.up:
            self.up[x], self.chars[x] = x, chars
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, step: dict, below: float = float("inf")) -> bool:
        """Join the step's lines if what they then hold together is ``below`` that."""
        x, y = self.top(step["pos"], step["chars"]), self.top(step["pos"] + step["apart"], step["next_chars"])
        chars = self.chars[x] if x == y else self.chars[x] + self.chars[y]
        if chars >= below:
            return False
        self.up[y], self.chars[x] = x, chars
        return True


SEARCH = "doc_id long, search array<struct<key: long, other: long, run: int>>, lines array<struct<pos: int, run: int>>"


def _search(min_chars: int):
    """Steps by which a document finds partners, and the lines that a partner may cut, by run of lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, steps in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                runs, short = _Runs(), _Runs()
                for s in steps:
                    runs.join(s)
                tops = {x: runs.top(x, 0) for x in list(runs.up)}
                steps = [s for s in steps if runs.chars[tops[s["pos"]]] >= min_chars]
                # The most frequent first: what they join stays too short for a block.
                steps.sort(key=lambda s: (-s["n"], s["pos"], s["apart"]))
                search = [{"key": s["key"], "other": s["other"], "run": tops[s["pos"]]}
                          for s in steps if not short.join(s, min_chars)]
                if search:
                    out.append({"doc_id": doc, "search": search, "lines": [
                        {"pos": x, "run": r} for x, r in tops.items() if runs.chars[r] >= min_chars]})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("doc_id", pa.int64()),
                ("search", pa.list_(pa.struct([("key", pa.int64()), ("other", pa.int64()), ("run", pa.int32())]))),
                ("lines", pa.list_(pa.struct([("pos", pa.int32()), ("run", pa.int32())])))]))

    return run


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id): the searched steps of runs with a line that is not cut yet."""
    for b in batches:
        keys, docs = [], []
        for doc, search, lines, cut in zip(*(c.to_pylist() for c in b.columns)):
            cut = set(cut or ())
            still = {x["run"] for x in lines if x["pos"] not in cut}
            own = [s["key"] for s in search if s["run"] in still]
            keys += own
            docs += [doc] * len(own)
        yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(docs, pa.int64())], ["key", "doc_id"])


def _pair_aligner(min_chars: int):
    """Rows of two documents' lines, of which equal ones are aligned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, cuts = [], []
            for doc, mine, theirs in zip(b.column(0), b.column(1), b.column(2)):
                mine = [mine[c].values.to_numpy(zero_copy_only=False).tolist() for c in
                        ("line_a", "line_b", "pos", "once", "chars")]
                theirs = [theirs[c].values.to_numpy(zero_copy_only=False).tolist() for c in
                          ("line_a", "line_b", "pos", "once")]
                have = {(x, y): (pos, once) for x, y, pos, once in zip(*theirs)}
                rows, size = [], {}
                for x, y, pos, once, chars in zip(*mine):
                    if (x, y) in have:
                        other_pos, other_once = have[x, y]
                        rows.append((pos, other_pos, once and other_once))
                        size[pos] = chars
                gone = [x for block in blocks(align(rows)) if sum(map(size.__getitem__, block)) >= min_chars
                        for x in block]
                if gone:
                    docs.append(doc.as_py())
                    cuts.append(gone)
            yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(cuts, pa.list_(pa.int32()))],
                                  ["doc_id", "cut"])

    return run


def _cut_by(pairs: DataFrame, docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, cut) of the documents of ``pairs`` (doc_id, other), by all their alignments."""
    mine = docs.select("doc_id", F.struct("line_a", "line_b", "pos", "once", "chars").alias("mine"))
    theirs = docs.select(F.col("doc_id").alias("other"), F.struct("line_a", "line_b", "pos", "once").alias("theirs"))
    rows = pairs.join(theirs, "other").join(mine, "doc_id").select("doc_id", "mine", "theirs")
    cut = rows.mapInArrow(_pair_aligner(min_chars), "doc_id long, cut array<int>")
    return cut.groupBy("doc_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("cut"))


def _cut_by_all(rows: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, cut) by alignment with every earlier document that can add to the cut."""
    docs = materialize(rows.mapInArrow(_doc_lines(min_chars), DOC_LINES), "doc-lines")
    # Copies; an id whose rows differ is none.
    single = (docs.groupBy("doc_id")
                  .agg(F.min("sign_a").alias("sign_a"), F.max("sign_a").alias("_a"),
                       F.min("sign_b").alias("sign_b"), F.max("sign_b").alias("_b"))
                  .filter("sign_a = _a AND sign_b = _b").select("doc_id", "sign_a", "sign_b"))
    single = materialize(single, "line-signs")
    copied = materialize(single.groupBy("sign_a", "sign_b")
                               .agg(F.min("doc_id").alias("other"), F.max("doc_id").alias("_last"))
                               .filter("other < _last").drop("_last"), "copied")
    copies = materialize(single.join(copied, ["sign_a", "sign_b"]).filter("doc_id > other")
                               .select("doc_id", "other"), "copies")
    steps = docs.select("doc_id", "pos", "line_a", "chars").mapInArrow(_step_table(min_chars), STEPS)
    first = materialize(steps.groupBy("key").agg(F.min("doc_id").alias("other"), F.max("doc_id").alias("_last"),
                                                 F.count(F.lit(1)).alias("n"))
                             .filter("other < _last").drop("_last"), "first-steps")
    shared = materialize(steps.join(first, "key").join(copies.select("doc_id"), "doc_id", "left_anti"), "steps")
    search = materialize(
        shared.filter("doc_id > other").groupBy("doc_id")
              .agg(F.collect_list(F.struct("n", "key", "pos", "apart", "chars", "next_chars", "other")).alias("s"))
              .mapInArrow(_search(min_chars), SEARCH), "step-search")
    pairs = materialize(search.select("doc_id", F.explode(F.array_distinct(F.col("search.other"))).alias("other"))
                              .distinct(), "line-pairs")
    cut = materialize(_cut_by(pairs.union(copies), docs, min_chars), "line-cuts")
    left = materialize(search.join(cut, "doc_id", "left").select("doc_id", "search", "lines", "cut")
                             .mapInArrow(_open, "key long, doc_id long"), "open-steps")
    holders = shared.select("key", F.col("doc_id").alias("other"))
    more = (left.join(holders, "key").filter("doc_id > other").select("doc_id", "other").distinct()
                .join(pairs, ["doc_id", "other"], "left_anti"))
    return cut.union(_cut_by(materialize(more, "line-pairs"), docs, min_chars))


def repeated_lines(docs: DataFrame, min_chars: int = 80, id_col: str = "doc_id",
                   text_col: str = "text", partners: str = "first") -> DataFrame:
    """(doc_id, cut): positions of the lines (from 0) to delete from later documents.

    ``min_chars`` is what a block must hold besides white space; ``partners``
    are the ``first`` holder of each line, or ``all`` earlier documents.
    """
    if partners not in ("first", "all"):
        raise ValueError(f"partners are first or all, not {partners}")
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if partners == "all":
        return (_cut_by_all(rows, min_chars).groupBy("doc_id")
                .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("cut")))
    lines = materialize(rows.mapInArrow(_line_table, LINES), "lines")
    key = ["line_a", "line_b", "k"]
    # Written before it is joined: a join of two plain tables may split a hot line.
    first = materialize(
        lines.groupBy(*key)
                  .agg(F.min(F.struct("doc_id", "pos", "times")).alias("f"), F.max("doc_id").alias("_last"))
                  .filter(F.col("_last") > F.col("f.doc_id"))
                  .select(*key, F.col("f.doc_id").alias("other"), F.col("f.pos").alias("other_pos"),
                          (F.col("f.times") == 1).alias("_once")), "first-lines")
    links = (lines.join(first, key).filter(F.col("doc_id") > F.col("other"))
                  .select("doc_id", "other", F.struct(
                      "pos", "other_pos", (F.col("_once") & (F.col("times") == 1)).alias("once"),
                      "chars").alias("line")))
    # A pair has at most as many shared lines as its documents have lines.
    pairs = links.groupBy("doc_id", "other").agg(F.sort_array(F.collect_list("line")).alias("shared"))
    cut = pairs.select("doc_id", "shared").mapInArrow(_aligner(min_chars), "doc_id long, cut array<int>")
    return cut.groupBy("doc_id").agg(F.array_sort(F.flatten(F.collect_list("cut"))).alias("cut"))


def line_dedup(docs: DataFrame, min_chars: int = 80, id_col: str = "doc_id",
               text_col: str = "text", partners: str = "first") -> DataFrame:
    """``docs`` with repeated line blocks deleted: columns as given, plus n_lines and n_cut.

    Lines are split at line feeds and compared byte by byte; the later of two
    documents is the one with the larger id.  What is left is joined by line
    feeds.  ``partners``: see ``repeated_lines``.

    Defined cases: null texts and ids pass unchanged (n_lines of a null text
    is 0); an empty text is one empty line; lines of white space alone are
    never counted as shared; rows with the same id count as one document (with
    ``first``, a line that such rows share is not shared with another); an
    empty table gives no rows; other columns, whatever their names, are passed through
    (columns named n_lines or n_cut are replaced).
    """
    key, gone = unused(docs, "cut_id"), unused(docs, "cut_lines")
    cut = repeated_lines(docs, min_chars, id_col, text_col, partners).withColumnsRenamed({"doc_id": key, "cut": gone})
    lines = F.split(F.col(text_col), "\n")
    kept = F.filter(lines, lambda line, i: ~F.array_contains(gone, i))
    return (docs.join(cut, docs[id_col].cast("long") == cut[key], "left")
                .withColumns({"n_lines": F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)),
                              "n_cut": F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)),
                              text_col: F.when(F.col(gone).isNull(), F.col(text_col))
                                         .otherwise(F.array_join(kept, "\n"))})
                .drop(key, gone))
