"""Periodic runs in word sequences, by internal pattern matching.

A run is a stretch of words that repeats with a smallest period q at least
four times and that neither neighbour extends.  The words of a batch of
documents become one sequence with a separator of its own after each
document.  At level k blocks of 2**k words start at every multiple of half
their length.  A run of period q, 2**(k-1) < q <= 2**k, holds a block b whose
copy at b + q lies in the run too; as the block is no shorter than the period
and the period is primitive, that copy is the block's next occurrence, and
b, b + q, b + 2q, ... are the occurrences' arithmetic progression.  So one
query gives the candidate period: the first occurrence after b in the
neighbouring window of 2**k places.  The block's occurrences are an interval
of the suffix array; a wavelet matrix over the array answers the range
successor query.  Candidates are then extended both ways by common extensions.

Most blocks need no query: in a run every word, but for those of its last period,
comes again within q words.  Blocks are passed over unless all their words come
again within 2**k words and the stretch of such words is as long as a run's
must be; only documents with a block left get a suffix array.

Documents are rows and no row meets another, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prefix_sums, range_hash, slices, text_buffer, word_spans

FAR = np.int64(1) << 60


class Suffixes:
    """Suffix array of a sequence whose suffixes all differ, with names of all 2**k-word blocks.

    ``names[k][i]`` are equal for equal stretches of 2**k words; they give
    ranks while doubling, and common extensions to both sides afterwards.
    """

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.names = [np.unique(codes, return_inverse=True)[1].astype(np.int64)]
        while self.names[-1].max(initial=-1) < n - 1:
            now, width = self.names[-1], 1 << (len(self.names) - 1)
            after = np.zeros(n, np.int64)
            after[:n - width] = now[width:] + 1
            self.names.append(np.unique(now * (n + 1) + after, return_inverse=True)[1].astype(np.int64))
        self.rank = self.names[-1]
        self.array = np.empty(n, np.int64)
        self.array[self.rank] = np.arange(n)
        self.lcp = np.zeros(n, np.int64)
        self.lcp[1:] = self.extension(self.array[:-1], self.array[1:])

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the stretches from i and from j have in common."""
        n, out = len(self.rank), np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            a, b = i + out, j + out
            same = (a < n) & (b < n)
            same[same] = self.names[k][a[same]] == self.names[k][b[same]]
            out += same.astype(np.int64) << k
        return out

    def extension_left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the stretches before i and before j have in common."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            a, b = i - out - (1 << k), j - out - (1 << k)
            same = (a >= 0) & (b >= 0)
            same[same] = self.names[k][a[same]] == self.names[k][b[same]]
            out += same.astype(np.int64) << k
        return out

    def intervals(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the array the interval [lo, hi) whose suffixes share ``length`` words with its own."""
        n = len(self.lcp)
        edge = self.lcp < length
        edge[:1] = True
        at = np.flatnonzero(edge)
        group = np.cumsum(edge) - 1
        return at[group], np.append(at[1:], n)[group]


class WaveletMatrix:
    """Counts and order statistics of value ranges in any stretch of a sequence of whole numbers."""

    def __init__(self, values: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, int]] = []
        top = int(values.max(initial=0)).bit_length()
        for bit in range(top - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            before = np.concatenate([[0], np.cumsum(zero)])
            self.levels.append((bit, before, int(before[-1])))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of [lo, hi) are less than x."""
        out = np.zeros(len(lo), np.int64)
        for bit, before, zeros in self.levels:
            a, b, one = before[lo], before[hi], (x >> bit) & 1 == 1
            out += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros + lo - a, a), np.where(one, zeros + hi - b, b)
        top = len(self.levels)
        return np.where(x >> top > 0, out + hi - lo, out) if top else np.where(x > 0, hi - lo, 0)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) of [lo, hi)."""
        out = np.zeros(len(lo), np.int64)
        for bit, before, zeros in self.levels:
            a, b = before[lo], before[hi]
            one = k >= b - a
            out |= one.astype(np.int64) << bit
            k = np.where(one, k - (b - a), k)
            lo, hi = np.where(one, zeros + lo - a, a), np.where(one, zeros + hi - b, b)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value of [lo, hi) that is x or more, else FAR."""
        less = np.zeros(len(lo), np.int64)
        inside = x >> max(len(self.levels), 1) == 0
        less[inside] = self.below(lo[inside], hi[inside], x[inside])
        less[~inside] = (hi - lo)[~inside]
        found = less < hi - lo
        out = np.full(len(lo), FAR)
        out[found] = self.smallest(lo[found], hi[found], less[found])
        return out


def _gaps(words: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Distance from each word to its next occurrence in the same row, else FAR."""
    order = np.lexsort((words, row))  # stable: places rise within a word
    out = np.full(len(words), FAR)
    same = (words[order[1:]] == words[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _blocks(words: np.ndarray, row: np.ndarray, last: np.ndarray, shortest: int,
            exponent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, starts) of the blocks in which, and in enough places around, every word comes again within the block's length."""
    half = gap = _gaps(words, row)
    longest = int(np.bincount(row).max(initial=0))
    level = 0
    while (1 << level) < 2 * (longest // exponent + 1):
        size = 1 << level
        if level == 0:
            starts = np.flatnonzero(gap <= 1)
        else:
            if level > 1:
                half = np.append(half, FAR) if len(half) % 2 else half
                half = np.maximum(half[0::2], half[1::2])
            starts = np.flatnonzero(np.maximum(half[:-1], half[1:]) <= size) * (size >> 1)
            starts = starts[starts + size <= len(words)]
        starts = starts[starts + size <= last[starts]]  # whole blocks of one document
        if len(starts):
            # All words of a run but those of its last period come again so near, and they follow each other.
            near = np.concatenate([[False], gap <= size, [False]])
            edges = np.flatnonzero(near[1:] != near[:-1])
            begin, most = edges[::2], np.diff(edges)[::2]
            least = max(shortest - size, (exponent - 1) * (size // 2 + 1))
            starts = starts[most[np.searchsorted(begin, starts, "right") - 1] >= least]
        if len(starts):
            yield level, starts
        level += 1


def find_runs(words: np.ndarray, first: np.ndarray, shortest: int = 6,
              exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start, then period.

    ``words`` are codes of the words of all rows, row r's being those from
    ``first[r]`` to ``first[r + 1]``; starts count over all rows.  A run has at
    least ``shortest`` words and ``exponent`` (4 or more) times its period.
    """
    none = np.zeros(0, np.int64)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    last = first[1:][row]
    queries = list(_blocks(words, row, last, shortest, exponent))
    if not queries:
        return none, none, none
    # The documents with a block left, each followed by a separator of its own.
    used = np.unique(np.concatenate([row[starts] for _, starts in queries]))
    mine = np.zeros(len(count), bool)
    mine[used] = True
    begin = np.concatenate([[0], np.cumsum(count[used] + 1)])
    shift = np.zeros(len(count), np.int64)
    shift[used] = begin[:-1] - first[:-1][used]
    inside = np.flatnonzero(mine[row])
    codes = np.empty(begin[-1], np.int64)
    codes[inside + shift[row[inside]]] = np.unique(words[inside], return_inverse=True)[1] + len(used)
    codes[begin[1:] - 1] = np.arange(len(used))
    suffixes = Suffixes(codes)
    occurrences = WaveletMatrix(suffixes.array)
    found = []
    for level, starts in queries:
        size = 1 << level
        at = starts + shift[row[starts]]
        lo, hi = (x[suffixes.rank[at]] for x in suffixes.intervals(size))
        again = hi - lo > 1
        at, lo, hi, starts = at[again], lo[again], hi[again], starts[again]
        period = occurrences.successor(lo, hi, at + 1) - at
        near = (period <= size) & (2 * period > size)  # shorter ones belong to lower levels
        at, period, starts = at[near], period[near], starts[near]
        left = suffixes.extension_left(at, at + period)
        length = left + period + suffixes.extension(at, at + period)
        long = length >= np.maximum(shortest, exponent * period)
        found.append(np.stack([(starts - left)[long], period[long], length[long]]))
    start, period, length = np.unique(np.concatenate(found, axis=1), axis=1)
    return start, length, period


def _gather(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of rows whose words are joined by one blank each."""
    size = ends - starts
    lead = np.ones(len(size), np.int64)  # a blank before each word but a row's first
    lead[first[:-1][first[:-1] < first[1:]]] = 0
    stop = np.cumsum(size + lead)
    out = np.full(stop[-1] if len(stop) else 0, 32, np.uint8)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(stop - size, size) + within] = flat[np.repeat(starts, size) + within]
    return out, np.concatenate([[0], stop])[first]


RUNS = "runs array<struct<start: long, length: long, period: long>>, collapsed string"

#: From the ids of rows and their numbers of words to the word that stands at each place (or None: as they are).
Rewrite = Callable[[list, np.ndarray], np.ndarray]


def _finder(shortest: int, exponent: int, rewrite: Rewrite | None):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            all_flat, offsets = text_buffer(batch.column(1))
            for lo, hi in slices(offsets):
                flat, offs = all_flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                ids = batch.column(0).slice(lo, hi - lo)
                starts, ends, first = word_spans(flat, offs)
                words = range_hash(prefix_sums(flat), starts, ends)
                count = np.diff(first)
                if rewrite is not None:
                    source = rewrite(ids.to_pylist(), count) + np.repeat(first[:-1], count)
                    words, starts, ends = words[source], starts[source], ends[source]
                at, length, period = find_runs(words, first, shortest, exponent)
                row = np.searchsorted(first, at, "right") - 1
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, at + period, 1)
                np.add.at(depth, at + length, -1)
                keep = np.cumsum(depth)[:-1] == 0
                left = np.concatenate([[0], np.cumsum(keep)])[first]
                data, begin = _gather(flat, starts[keep], ends[keep], left)
                runs = pa.StructArray.from_arrays([pa.array(x) for x in (at - first[row], length, period)],
                                                  fields=list(kind))
                each = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                text = pa.StringArray.from_buffers(hi - lo, pa.py_buffer(begin.astype(np.int32).tobytes()),
                                                   pa.py_buffer(data.tobytes()))
                yield pa.record_batch([ids, pa.ListArray.from_arrays(pa.array(each), runs), text],
                                      names=["doc_id", "runs", "collapsed"])
    return find


def periodic_runs(docs: DataFrame, shortest: int = 6, exponent: int = 4, rewrite: Rewrite | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period) and collapsed text of every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` of whole texts, numbered from 0, equal
    when identical (by a 64-bit hash of their bytes).  ``collapsed`` joins by one
    blank the words that no run holds after its first ``period`` words.
    ``rewrite`` may put other words of the same document at its places first.

    Defined cases: a null, empty or blank text has no words, no runs and an
    empty collapsed text; a text of any length is taken whole (its memory grows
    with its words times the logarithm of their number); runs may overlap and
    tie, each is listed once; repeated rows and null ids are rows like others;
    an empty table gives no rows; further columns are ignored.
    """
    if exponent < 4:
        raise ValueError("blocks find every run only from exponent 4 on")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_finder(shortest, exponent, rewrite), f"doc_id long, {RUNS}")


def run_digests(found: DataFrame) -> DataFrame:
    """Per document: number of runs, the longest one (then the first, then the shortest period), and digests."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("(1000 * _best.length) div (-_best.period)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
