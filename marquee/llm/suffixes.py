"""Repeated substrings by difference-cover blockwise suffix sorting.

Wanted are the places whose ``length``-byte string also starts elsewhere.

1. Candidates.  A string's owner is the place of its least 8-byte gram (by a
   hash; the leftmost of equal ones), so equal strings have their owner at the
   same offset.  Neighbouring places with one owner, in steps of ``STEP``
   offsets, form a stretch, and all strings of a stretch share a core of
   ``length - STEP + 1`` bytes.  Equal strings therefore have equal cores:
   stretches whose core is found once hold no repeat, and that settles most.
   Stretches that are equal as a whole are counted, not sorted.
2. Suffix buckets.  The other stretches are dealt into buckets by their core.
   A bucket is sorted at a time: suffixes by their first ``period`` bytes,
   then tied ones by three-way partitions around a pivot.  Two tied suffixes
   are compared by the precomputed ranks of a difference-cover sample: some
   shift below ``period`` brings both to sample places, whose ranks tell the
   next bytes apart without reading them; the last bytes are compared as they
   are.  Memory is that of the bucket, whatever the length of the ties.
3. A core with more kinds of stretch than a bucket holds (a passage found all
   over the corpus, between different neighbours) is dealt by further bytes: its
   stretches are cut again in steps of fewer offsets, whose cores are longer,
   and the same two stages decide these.  With steps of one offset the core is
   the string itself, so this ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (BASE_B, SLICE_BYTES, U64, as_signed, materialize, mix, prefix_sums, range_hash, slices,
                     text_buffer)

GRAM = 8
#: Offsets of one stretch; bytes of one bucket; kinds of stretch of one core in a bucket; steps are refined by FINER.
STEP, BUCKET_BYTES, HEAVY, FINER = 128, 2 << 20, 2048, 8


# --- stretches ---------------------------------------------------------------

def stretches(flat: np.ndarray, room: np.ndarray, length: int, step: int):
    """(start, count, core hash, whole hash) of the stretches among the first ``len(room)`` places.

    ``room[i]`` is how many bytes the text has from place i on.
    """
    n = len(flat) - length + 1
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    if n <= 0:
        return empty
    flat = np.ascontiguousarray(flat)
    grams = np.ndarray((len(flat) - GRAM + 1,), "<u8", flat, strides=(1,)) * U64(0x9FB21C651E98DF25)
    grams ^= grams >> U64(29)
    grams *= U64(0xBF58476D1CE4E5B9)
    least = (grams & U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U64)
    width, size = length - GRAM + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[:len(least) - (width - size)], least[width - size:])
    n = min(n, len(room))
    place = np.arange(n)
    owner = (least[:n] & U64(0xFFFFFFFF)).astype(np.int64)
    tier = (owner - place) // step
    full = room[:n] >= length
    cut = np.ones(n, bool)
    cut[1:] = (owner[1:] != owner[:-1]) | (tier[1:] != tier[:-1]) | (full[1:] != full[:-1])
    start = np.flatnonzero(cut)
    count = np.diff(np.append(start, n))
    ok = full[start]
    start, count = start[ok], count[ok]
    if not len(start):
        return empty
    core = owner[start] - tier[start] * step
    a, b = prefix_sums(flat), prefix_sums(flat, BASE_B)
    core_hash = range_hash(a, core, core + length - step + 1)
    whole = range_hash(b, start, start + count - 1 + length, BASE_B)
    whole = mix(whole + (core - start).astype(U64) * U64(0xA24BAED4963EE407) + count.astype(U64))
    return start, count, core_hash, whole


def _chunks(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, begin, end of the places) in pieces of bounded size."""
    for lo, hi in slices(offsets):
        for c in range(int(offsets[lo]), int(offsets[hi]), SLICE_BYTES):
            yield lo, hi, c, min(c + SLICE_BYTES, int(offsets[hi]))


def _stretch_table(length: int, step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, offsets = text_buffer(b.column(2))
            for lo, hi, c, z in _chunks(offsets, length):
                sizes = np.diff(offsets[lo:hi + 1])
                ends = np.repeat(offsets[lo + 1:hi + 1], sizes)[c - offsets[lo]:z - offsets[lo]]
                start, count, core, whole = stretches(flat[c:min(z + length - 1, int(offsets[hi]))],
                                                      ends - np.arange(c, z), length, step)
                row = np.searchsorted(offsets, start + c, "right") - 1
                yield pa.record_batch(
                    [b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)),
                     pa.array(start + c - offsets[row]), pa.array(count.astype(np.int32)),
                     pa.array(as_signed(core)), pa.array(as_signed(whole))],
                    ["k1", "k2", "start", "n", "core", "whole"])

    return run


# --- suffix sorting ------------------------------------------------------------

@lru_cache
def difference_cover(period: int) -> tuple[np.ndarray, np.ndarray]:
    """(mask of the cover, shift[i, j] that brings residues i and j into it), found greedily."""
    cover, missing = [0], set(range(1, period))
    while missing:
        def gain(x: int) -> int:
            return len(missing & {d for y in cover for d in ((x - y) % period, (y - x) % period)})

        best = max(range(period), key=gain)
        missing -= {d for y in cover for d in ((best - y) % period, (y - best) % period)}
        cover.append(best)
    mask = np.zeros(period, bool)
    mask[cover] = True
    shift = np.zeros((period, period), np.int64)
    for i in range(period):
        for j in range(period):
            shift[i, j] = next(s for s in range(period) if mask[(i + s) % period] and mask[(j + s) % period])
    return mask, shift


def _words(flat: np.ndarray) -> np.ndarray:
    """Big-endian 8-byte words at every place (their order is that of the bytes)."""
    padded = np.concatenate([flat, np.zeros(GRAM, np.uint8)])
    return np.ndarray((len(flat) + 1,), ">u8", padded, strides=(1,)).astype(U64)


def _ranked(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank of each) by several keys, the first first; equal keys, equal rank."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def cover_ranks(flat: np.ndarray, words: np.ndarray, period: int, depth: int) -> np.ndarray:
    """At sample places the rank of the next ``depth`` bytes (a multiple of ``period``), else -1.

    By doubling: the cover repeats with ``period``, so a place a multiple of
    it further on is in the sample too.
    """
    mask, _ = difference_cover(period)
    place = np.flatnonzero(np.resize(mask, len(flat)))
    place = place[place + period <= len(flat)]
    rank = np.full(len(flat) + depth + 1, -1, np.int64)
    if not len(place):
        return rank
    _, r = _ranked([words[place + k] for k in range(0, period, GRAM)])
    reached = period
    while True:
        rank[place] = r
        if reached == depth:
            return rank
        far = min(reached, depth - reached)  # the second half may overlap the first
        _, r = _ranked([r, rank[place + far]])
        reached += far


def repeated(flat: np.ndarray, places: np.ndarray, length: int, period: int) -> np.ndarray:
    """Which of ``places`` (each with ``length`` bytes after it) have a string that another one has."""
    _, shift = difference_cover(period)
    depth = (length - period) // period * period
    words = _words(flat)
    rank = cover_ranks(flat, words, period, depth)
    order, first = _ranked([words[places + k] for k in range(0, period, GRAM)])
    tail = [*range(depth, length - GRAM, GRAM), length - GRAM]
    out = np.zeros(len(places), bool)
    todo, group = order, first[order]
    while len(todo):
        begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(begin, len(todo)))
        keep = np.repeat(size > 1, size)
        todo, size = todo[keep], size[size > 1]
        if not len(todo):
            break
        begin = np.cumsum(size) - size
        i = places[todo]
        pivot = np.repeat(places[todo[begin + size // 2]], size)
        s = shift[i % period, pivot % period]
        a, b = rank[i + s], rank[pivot + s]
        side = np.sign(a - b)
        for k in tail:
            tied = np.flatnonzero(side == 0)
            x, y = words[i[tied] + k], words[pivot[tied] + k]
            side[tied] = (x > y).astype(np.int64) - (x < y)
        own = np.repeat(np.arange(len(size)), size)
        equal = side == 0
        out[todo[equal]] = np.bincount(own[equal], minlength=len(size))[own[equal]] > 1
        todo, group = todo[~equal], (3 * own + side)[~equal]
        order = np.argsort(group, kind="stable")
        todo, group = todo[order], group[order]
    return out


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


_MARKS = "core long, whole long, runs array<struct<lo:int,hi:int>>"
_RUNS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


def _sort_bucket(length: int, period: int):
    """One bucket (core, whole, n, body): the runs of repeated places in each stretch."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        n = table["n"].to_numpy().astype(np.int64)
        bodies = [x.as_py() for x in table["body"]]
        flat = np.frombuffer(b"".join(bodies), np.uint8)
        begin = np.cumsum([0, *map(len, bodies)])[:-1]
        upto = np.concatenate([[0], np.cumsum(n)])
        places = np.repeat(begin - upto[:-1], n) + np.arange(upto[-1])
        hit = repeated(flat, places, length, period)
        runs = [[{"lo": a, "hi": b} for a, b in _runs(hit[upto[k]:upto[k + 1]])] for k in range(len(n))]
        return pa.table({"core": table["core"], "whole": table["whole"], "runs": pa.array(runs, _RUNS)})

    return run


# --- the job -------------------------------------------------------------------

def _cut_bodies(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (data, wanted stretches) to rows (core, whole, n, heavy, body)."""
    kind = pa.schema([("core", pa.int64()), ("whole", pa.int64()), ("n", pa.int32()), ("heavy", pa.bool_()),
                      ("body", pa.binary())])
    for b in batches:
        rows: list[tuple] = []
        for text, wanted in zip(b.column(0), b.column(1)):
            data = text.as_py() or b""
            data = data.encode() if isinstance(data, str) else data
            for w in wanted.as_py():
                rows.append((w["core"], w["whole"], w["n"], w["heavy"],
                             data[w["start"]:w["start"] + w["n"] - 1 + length]))
            if len(rows) > 20_000:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], kind)
                rows = []
        if rows:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], kind)


def _repeated_runs(rows: DataFrame, length: int, step: int) -> DataFrame:
    """(k1, k2, runs): runs [lo, hi) of places whose string starts elsewhere too; a row's runs may be in several rows.

    ``rows`` has the key k1 (may be null), k2 and data (text or bytes); rows of one key have the same data.
    """
    period = 40 if length >= 80 else GRAM
    # Every place of every text is covered here; a stretch is one of about 90 places.
    found = materialize(rows.mapInArrow(_stretch_table(length, step),
                                        "k1 long, k2 long, start long, n int, core long, whole long"), "stretches")
    # (Written before it is joined: a join of two plain tables may split a hot core.)
    cores = materialize(found.groupBy("core").agg(F.count(F.lit(1)).alias("_c"))
                             .filter("_c > 1").select("core"), "cores")
    again = materialize(found.join(cores, "core"), "repeated-cores")
    kinds = materialize(again.groupBy("core", "whole").agg(
        F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        F.min(F.struct(F.col("k1").isNull(), "k1", "k2", "start")).alias("at")), "kinds")
    several = materialize(kinds.groupBy("core").agg(F.count(F.lit(1)).alias("_kinds"))
                               .filter("_kinds > 1"), "several")
    mixed = kinds.join(several, "core")
    # One text of each kind of stretch, cut out where the kind was first seen.
    heavy = F.col("_kinds") > HEAVY if step > 1 else F.lit(False)
    wanted = (mixed.withColumn("heavy", heavy)
                   .groupBy(F.col("at.k1").alias("_k1"), F.col("at.k2").alias("_k2"))
                   .agg(F.collect_list(F.struct("core", "whole", "n", "heavy", F.col("at.start").alias("start")))
                         .alias("wanted")))
    same = F.col("k1").eqNullSafe(F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    bodies = materialize(
        rows.join(wanted, same).select("data", "wanted")
            .mapInArrow(lambda it: _cut_bodies(it, length),
                        "core long, whole long, n int, heavy boolean, body binary"), "bodies")
    total = bodies.filter("NOT heavy").agg(F.sum(F.length("body"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    sorted_marks = (bodies.filter("NOT heavy").select("core", "whole", "n", "body")
                          .groupBy(F.pmod("core", F.lit(buckets)).alias("_bucket"))
                          .applyInArrow(_sort_bucket(length, period), _MARKS))
    more = bodies.filter("heavy")
    if step > 1 and more.limit(1).count():
        finer = _repeated_runs(more.select(F.col("core").alias("k1"), F.col("whole").alias("k2"),
                                           F.col("body").alias("data")), length, max(1, step // FINER))
        sorted_marks = sorted_marks.unionByName(finer.select(
            F.col("k1").alias("core"), F.col("k2").alias("whole"),
            F.transform("runs", lambda r: F.struct(r["lo"].cast("int").alias("lo"), r["hi"].cast("int").alias("hi")))
             .alias("runs")))
    marks = materialize(sorted_marks.filter(F.size("runs") > 0), "marks")
    # Copies of a whole stretch: every place is repeated; else what its bucket says.
    whole_marks = kinds.filter("copies > 1").select(
        "core", "whole", F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi"))).alias("runs"))
    lone = marks.join(kinds.filter("copies = 1").select("core", "whole"), ["core", "whole"])
    every = whole_marks.unionByName(lone.select("core", "whole", "runs"))
    return again.join(every, ["core", "whole"]).select("k1", "k2", F.transform(
        "runs", lambda r: F.struct((F.col("start") + r["lo"]).alias("lo"),
                                   (F.col("start") + r["hi"]).alias("hi"))).alias("runs"))


def repeated_places(rows: DataFrame, length: int = 400) -> DataFrame:
    """(k1, k2, spans): byte ranges [lo, hi) covered by strings that start elsewhere too, sorted, unmerged.

    ``rows`` has a key k1 (may be null), k2 and data; rows of one key have the same data.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    runs = _repeated_runs(rows, length, min(STEP, length // 3))
    spans = F.transform(F.flatten(F.collect_list("runs")), lambda r: F.struct(
        r["lo"].alias("lo"), (r["hi"] - 1 + length).alias("hi")))
    return runs.groupBy("k1", "k2").agg(F.sort_array(spans).alias("spans"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, spans) to (doc_id, n_bytes, removed ranges merged, kept bytes)."""
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    for b in batches:
        size, merged, kept = [], [], []
        for text, spans in zip(b.column(1), b.column(2).to_pylist()):
            data = (text.as_py() or "").encode()
            out: list[dict] = []
            for s in spans or ():
                if out and s["lo"] <= out[-1]["hi"]:
                    out[-1]["hi"] = max(out[-1]["hi"], s["hi"])
                else:
                    out.append({"lo": s["lo"], "hi": s["hi"]})
            cuts = [0, *(x for s in out for x in (s["lo"], s["hi"])), len(data)]
            size.append(len(data))
            merged.append(out)
            kept.append(b"".join(data[x:y] for x, y in zip(cuts[::2], cuts[1::2])))
        yield pa.record_batch([b.column(0), pa.array(size, pa.int64()), pa.array(merged, kind),
                               pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"])


def substring_dedup(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, removed (maximal ranges [lo, hi)), kept (bytes).

    Removed is every byte covered by a ``length``-byte string that also starts
    anywhere else in the texts, the same one included, overlaps counted.

    Defined cases: a null text is empty; texts shorter than ``length`` lose
    nothing; each row is judged by its own text, whatever its id: rows with a
    null or repeated id and other texts lose only what they have repeated
    themselves, rows that agree in both are copies; an empty table gives no
    rows; further columns are ignored.
    """
    # A row is known by its id and a hash of its text: rows that agree in both have the same spans.
    rows = docs.select(F.col(id_col).cast("long").alias("k1"), F.xxhash64(text_col).alias("k2"),
                       F.col(text_col).alias("data"))
    spans = repeated_places(rows, length).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "spans")
    same = F.col("k1").eqNullSafe(F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    return (rows.join(spans, same, "left").select("k1", "data", "spans")
                .mapInArrow(_remove, "doc_id long, n_bytes long, removed array<struct<lo:bigint,hi:bigint>>, kept binary"))
