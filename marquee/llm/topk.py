"""Exact top-k search by inner product over whole-number vectors, with a pivot-distance index.

Index.  Equal vectors are one entry that keeps its smallest ids (k + 1 are
enough for any query, its own row included).  A bounded sample gives pivots;
every entry is keyed by its nearest pivot and its distance to it, sorted by
both and cut into annuli of a bounded number of entries.

Search.  Distinct query vectors are keyed and cut in blocks alike.  First each
block meets the annuli of its own pivot that hold its distances, and widening
ones until they have k + 1 rows: that gives each query a score to beat.  Then
it meets every other annulus that the bounds do not rule out: for an entry x in
an annulus [lo, hi] around p, |q - x| >= gap = max(0, |q - p| - hi, lo - |q - p|),
so q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2 <= (|q|^2 + |x|^2 - gap^2) / 2.  What
falls short of the score to beat cannot be among the results, so they are exact.

A block and an annulus meet as two rows of a join, in one matrix product.  No
row is made for a pair of vectors: a meeting returns k + 1 rows a query at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, text_buffer

#: Sample of distinct vectors that the pivots are fitted on, pivots, and rounds of the fit.
SAMPLE, PIVOTS, FIT_ROUNDS = 4096, 64, 8
#: Entries of an annulus and queries of a block (bounds of one meeting), queries multiplied at a time.
ANNULUS, QUERY_BLOCK, AT_A_TIME = 8192, 2048, 256
#: Share of the squares that is added to a bound, so that rounding never drops a query.
SLACK = 1e-6
LONG = np.iinfo(np.int64)
WIDTHS = (2, 4, 8)


# --- packed vectors: one byte of width, then little-endian whole numbers ------------

def _pack(rows: np.ndarray) -> list[bytes]:
    """Each row in the least of the ``WIDTHS`` that holds it, so equal rows have equal bytes."""
    top = np.maximum(rows.max(axis=1, initial=0), -(rows.min(axis=1, initial=0) + 1))
    need = np.where(top < 1 << 15, 2, np.where(top < 1 << 31, 4, 8))
    out: list[bytes] = [b""] * len(rows)
    for width in np.unique(need):
        at = np.flatnonzero(need == width)
        data, size = rows[at].astype(f"<i{width}").tobytes(), rows.shape[1] * width
        for i, r in enumerate(at):
            out[r] = bytes([width]) + data[i * size:(i + 1) * size]
    return out


def _unpack(packed: pa.Array, size: int) -> np.ndarray:
    """Whole-number matrix of packed vectors; missing components count as 0."""
    flat, offs = text_buffer(packed)
    out = np.zeros((len(packed), size), np.int64)
    width = flat[offs[:-1]] if len(packed) else np.zeros(0, np.uint8)
    length = np.diff(offs) - 1
    for w, n in {(int(a), int(b)) for a, b in zip(width, length)}:
        at = np.flatnonzero((width == w) & (length == n))
        if n:
            own = flat[offs[at][:, None] + 1 + np.arange(n)]
            out[at, :n // w] = np.ascontiguousarray(own).view(f"<i{w}")
    return out


def _whole(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix of whole numbers) of the rows of (id, embedding) that take part."""
    for b in batches:
        ids, column = b.column(0), b.column(1)
        values = column.flatten()
        ok = np.asarray(column.is_valid()) & np.asarray(ids.is_valid())
        size = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(size)])
        numbers = np.asarray(values.fill_null(float("nan")), dtype=np.float64)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(numbers))])
        ok &= bad[begin[1:]] == bad[begin[:-1]]
        with np.errstate(invalid="ignore", over="ignore"):
            numbers = np.floor(numbers * scale)
        # Beyond 64 bits the nearest whole number of 64 bits counts.
        big = np.abs(np.nan_to_num(numbers)) >= 2.0 ** 63
        whole = np.where(big | ~np.isfinite(numbers), 0, numbers).astype(np.int64)
        whole[big] = np.where(numbers[big] > 0, LONG.max, LONG.min)
        whole_ids = np.asarray(ids.fill_null(0)).astype(np.int64)
        for n in np.unique(size[ok]):
            at = np.flatnonzero(ok & (size == n))
            yield whole_ids[at], whole[begin[at][:, None] + np.arange(n)]


def whole_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec, square) of the rows that take part: floor(scale * x) of each component, packed; their square."""
    def pack(batches):
        for ids, whole in _whole(batches, scale):
            yield pa.record_batch([pa.array(ids), pa.array(_pack(whole), pa.binary()), pa.array(_squares(whole))],
                                  names=["vec_id", "vec", "square"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    return rows.mapInArrow(pack, "vec_id long, vec binary, square long")


# --- index --------------------------------------------------------------------------

def entries(rows: DataFrame, keep: int) -> DataFrame:
    """(vec, ids): distinct vectors with their ``keep`` smallest row ids.

    Batches are combined before the shuffle, then copies in 64 parts, so a
    vector that a third of all rows share moves a few ids for each batch.
    """
    def combine(batches):
        for b in batches:
            own: dict[bytes, list[int]] = {}
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own.setdefault(v, []).append(i)
            yield pa.record_batch([pa.array(list(own), pa.binary()),
                                   pa.array([sorted(x)[:keep] for x in own.values()], pa.list_(pa.int64()))],
                                  names=["vec", "ids"])

    least = F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids")
    parts = rows.select("vec_id", "vec").mapInArrow(combine, "vec binary, ids array<long>")
    parts = parts.groupBy("vec", F.pmod(F.xxhash64("ids"), F.lit(64)).alias("_part")).agg(least)
    return parts.groupBy("vec").agg(least)


def fit_pivots(distinct: DataFrame, size: int, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Centres of a bounded sample: the ``sample`` distinct vectors of least hash."""
    drawn = distinct.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(sample).toArrow()
    points = _unpack(drawn.column("vec").combine_chunks(), size).astype(np.float64)
    if not len(points):
        return np.zeros((1, size))
    centres = points[:pivots].copy()
    for _ in range(FIT_ROUNDS):
        near = _distances(points, centres).argmin(axis=1)
        for j in np.unique(near):
            centres[j] = points[near == j].mean(axis=0)
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None] - 2 * (x @ centres.T)
    return np.sqrt(np.maximum(square, 0))


def keyed(distinct: DataFrame, centres: np.ndarray) -> DataFrame:
    """``distinct`` (vec, ids) with the nearest pivot and the distance to it, range-sorted by both."""
    size = centres.shape[1]

    def key(batches):
        for b in batches:
            away = _distances(_unpack(b.column(0), size).astype(np.float64), centres)
            near = away.argmin(axis=1)
            yield pa.record_batch([pa.array(near.astype(np.int32)), pa.array(away[np.arange(len(near)), near]),
                                   b.column(0), b.column(1)], names=["pivot", "away", "vec", "ids"])

    rows = distinct.mapInArrow(key, "pivot int, away double, vec binary, ids array<long>")
    order = ["pivot", "away", "vec"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def annuli(rows: DataFrame, centres: np.ndarray, limit: int) -> DataFrame:
    """Consecutive rows of one pivot, at most ``limit``, as one row: block, pivot, lo, hi, top, n, vecs, ids.

    ``top`` is the greatest squared length; ``n`` the number of ids kept.
    """
    size = centres.shape[1]

    def cut(batches):
        from pyspark import TaskContext

        block, held, held_rows = TaskContext.get().partitionId() << 40, [], 0

        def emit(part: pa.Table) -> pa.RecordBatch:
            vecs = part.column("vec").combine_chunks()
            whole = _unpack(vecs, size).astype(np.float64)
            ids = part.column("ids").combine_chunks()
            away = np.asarray(part.column("away"))
            return pa.record_batch(
                [pa.array([block]), pa.array([part.column("pivot")[0].as_py()], pa.int32()),
                 pa.array([away.min()]), pa.array([away.max()]), pa.array([(whole * whole).sum(axis=1).max()]),
                 pa.array([len(ids.flatten())], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(vecs)], pa.int32()), vecs),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)],
                names=["block", "pivot", "lo", "hi", "top", "n", "vecs", "ids"])

        for b in batches:
            pivot = np.asarray(b.column(0))
            edges = np.concatenate([[0], np.flatnonzero(np.diff(pivot)) + 1, [len(pivot)]]) if len(pivot) else [0]
            for a, z in zip(edges, edges[1:]):
                if held and held[0].column(0)[0].as_py() != int(pivot[a]):
                    yield emit(pa.Table.from_batches(held))
                    block, held, held_rows = block + 1, [], 0
                while a < z:
                    part = b.slice(a, min(z - a, limit - held_rows))
                    held.append(part)
                    held_rows, a = held_rows + len(part), a + len(part)
                    if held_rows == limit:
                        yield emit(pa.Table.from_batches(held))
                        block, held, held_rows = block + 1, [], 0
        if held:
            yield emit(pa.Table.from_batches(held))

    return rows.mapInArrow(cut, "block long, pivot int, lo double, hi double, top double, n long, "
                                "vecs array<binary>, ids array<array<long>>")


# --- search -------------------------------------------------------------------------

def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (beyond 64 bits the nearest long)."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if top < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < 2.0 ** 62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, int(LONG.min), int(LONG.max)).astype(np.int64)


def _met(centres: np.ndarray, keep: int):
    """Arrow function of meetings: the ``keep`` best rows of each query that reach its score to beat.

    Columns of a meeting: qvecs (array of packed queries), beat (array of long,
    null where none yet), pivot, lo, hi, top, vecs, ids.
    """
    size = centres.shape[1]

    def meet(batches):
        for b in batches:
            for r in range(b.num_rows):
                one = b.slice(r, 1)
                packed = one.column("qvecs").flatten()
                queries = _unpack(packed, size)
                beat = np.asarray(one.column("beat").flatten().fill_null(int(LONG.min))).astype(np.int64)
                pivot, lo, hi, top = (one.column(c)[0].as_py() for c in ("pivot", "lo", "hi", "top"))
                real = queries.astype(np.float64)
                away = _distances(real, centres[pivot:pivot + 1])[:, 0]
                gap = np.maximum(np.maximum(away - hi, lo - away), 0)
                bound = ((real * real).sum(axis=1) + top - gap * gap) / 2
                slack = 1 + SLACK * ((real * real).sum(axis=1) + top + gap * gap)
                live = np.flatnonzero(bound + slack >= beat.astype(np.float64))
                if not len(live):
                    continue
                lists = one.column("ids").flatten()
                flat = np.asarray(lists.flatten()).astype(np.int64)
                owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()).astype(np.int64))
                vectors = _unpack(one.column("vecs").flatten(), size)
                for a in range(0, len(live), AT_A_TIME):
                    part = live[a:a + AT_A_TIME]
                    scores = _products(queries[part], vectors)[:, owner]
                    if scores.shape[1] > keep:  # all that reach the keep-th best of this annulus, ties too
                        floor = np.maximum(np.partition(scores, -keep, axis=1)[:, -keep], beat[part])
                    else:
                        floor = beat[part]
                    q, x = np.nonzero(scores >= floor[:, None])
                    score, ids = scores[q, x], flat[x]
                    order = np.lexsort((ids, -score, q))
                    q, score, ids = q[order], score[order], ids[order]
                    place = np.arange(len(q)) - np.searchsorted(q, q)
                    good = place < keep
                    yield pa.record_batch([packed.take(pa.array(part[q[good]])), pa.array(score[good]),
                                           pa.array(ids[good])], names=["vec", "score", "vec_id"])
    return meet


def _squares(rows: np.ndarray) -> np.ndarray:
    """Each row's inner product with itself, as ``_products`` has it."""
    top = float(np.abs(rows).max(initial=0)) ** 2 * max(rows.shape[1], 1)
    if top < 2.0 ** 62:
        return (rows * rows).sum(axis=1)
    return np.array([min(sum(int(x) * int(x) for x in r), int(LONG.max)) for r in rows], np.int64)


REACH = "q_block long, q_top double, worst double, pivot int, q_lo double, q_hi double"


def _reach(centres: np.ndarray):
    """Arrow function: for each block of queries (q_block, qvecs, beat) and pivot, how far its queries are from it.

    ``worst`` is the least score to beat of the block, null if a query has none.
    """
    size, n = centres.shape[1], len(centres)

    def reach(batches):
        for b in batches:
            for r in range(b.num_rows):
                one = b.slice(r, 1)
                real = _unpack(one.column("qvecs").flatten(), size).astype(np.float64)
                away, beat = _distances(real, centres), one.column("beat").flatten()
                worst = None if beat.null_count else float(min(beat.to_pylist()))
                yield pa.record_batch(
                    [pa.array([one.column("q_block")[0].as_py()] * n), pa.array([(real * real).sum(axis=1).max()] * n),
                     pa.array([worst] * n, pa.float64()), pa.array(np.arange(n), pa.int32()),
                     pa.array(away.min(axis=0)), pa.array(away.max(axis=0))],
                    names=["q_block", "q_top", "worst", "pivot", "q_lo", "q_hi"])
    return reach


def _best(rows: DataFrame, keep: int) -> DataFrame:
    """(vec, best): the ``keep`` best (score, vec_id) of each query vector, best first."""
    # Ranks are cut before the shuffle as well; a query vector is distinct, so no key is hot.
    place = F.row_number().over(W.partitionBy("vec").orderBy(F.desc("score"), "vec_id"))
    first = rows.withColumn("_place", place).filter(F.col("_place") <= keep)
    pairs = F.sort_array(F.collect_list(F.struct("_place", "score", "vec_id")))
    return first.groupBy("vec").agg(F.transform(pairs, lambda p: F.struct(
        p["score"].alias("score"), p["vec_id"].alias("vec_id"))).alias("best"))


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, pivots: int = PIVOTS,
                id_col: str = "vec_id", vector_col: str = "embedding", annulus: int = ANNULUS,
                query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best rows of ``vectors`` for each row of ``queries``.

    Components are floor(scale * x); the score is the inner product; ties go to
    the smaller vec_id.  ``queries`` are rows of ``vectors``: a query's own row
    is no candidate, another row with the same id is.

    Defined cases: rows with a null id, a null vector, or a null or non-finite
    component take no part; the components that a shorter vector lacks count as 0
    (an empty vector scores 0); repeated rows are candidates each, and queries
    each; fewer than k other rows give fewer results; an empty table gives none;
    beyond 64 bits the nearest long stands; further columns are ignored.
    """
    keep = k + 1
    rows = materialize(whole_vectors(vectors, scale, id_col, vector_col), "vectors")
    asked = materialize(whole_vectors(queries, scale, id_col, vector_col)
                        .withColumnRenamed("vec_id", "query_id"), "queries")
    distinct = materialize(entries(rows, keep), "entries")
    size = distinct.agg(F.max(F.expr("(octet_length(vec) - 1) div ascii(substr(vec, 1, 1))"))).first()[0] or 0
    centres = fit_pivots(distinct, size, pivots)
    index = materialize(annuli(keyed(distinct, centres), centres, annulus), "annuli")
    wanted = asked.select("vec").distinct().withColumn("ids", F.array().cast("array<long>"))
    blocks = materialize(annuli(keyed(wanted, centres), centres, query_block)
                         .select(F.col("block").alias("q_block"), F.col("pivot").alias("q_pivot"),
                                 F.col("lo").alias("q_lo"), F.col("hi").alias("q_hi"), F.col("top").alias("q_top"),
                                 F.col("vecs").alias("qvecs")), "query-blocks")
    meet = _met(centres, keep)

    def results(pairs: DataFrame, asking: DataFrame) -> DataFrame:
        """Meetings of (q_block, block) rows."""
        met = pairs.join(asking, "q_block").join(index, "block")
        return met.select("qvecs", "beat", "pivot", "lo", "hi", "top", "vecs", "ids").mapInArrow(
            meet, "vec binary, score long, vec_id long")

    # Annuli by distance from the block's own, until they have k + 1 rows: the scores to beat.
    shapes = index.select("block", "pivot", "lo", "hi", "top", "n")
    apart = F.greatest(F.col("lo") - F.col("q_hi"), F.col("q_lo") - F.col("hi"), F.lit(0.0))
    before = W.partitionBy("q_block").orderBy("_apart", "block").rowsBetween(W.unboundedPreceding, -1)
    near = (blocks.select("q_block", "q_pivot", "q_lo", "q_hi")
                  .join(shapes, F.col("q_pivot") == F.col("pivot")).withColumn("_apart", apart)
                  .withColumn("_rows", F.coalesce(F.sum("n").over(before), F.lit(0))))
    home = materialize(near.filter((F.col("_apart") == 0) | (F.col("_rows") < keep)).select("q_block", "block"),
                       "home")
    unbeaten = blocks.select("q_block", "qvecs",
                             F.transform("qvecs", lambda v: F.lit(None).cast("long")).alias("beat"))
    first = materialize(_best(results(home, unbeaten), keep), "first")

    # Every other annulus that may hold a row as good as a query's last one so far.
    last = F.when(F.size("best") == keep, F.element_at("best", -1)["score"])
    one = blocks.select("q_block", F.posexplode("qvecs").alias("_i", "vec"))
    beats = (one.join(first.select("vec", last.alias("beat")), "vec", "left").groupBy("q_block")
                .agg(F.sort_array(F.collect_list(F.struct("_i", "vec", "beat"))).alias("_b"))
                .select("q_block", F.transform("_b", lambda x: x["vec"]).alias("qvecs"),
                        F.transform("_b", lambda x: x["beat"]).alias("beat")))
    armed = materialize(beats, "armed")
    gap = F.greatest(F.col("q_lo") - F.col("hi"), F.col("lo") - F.col("q_hi"), F.lit(0.0))
    bound = (F.col("q_top") + F.col("top") - gap * gap) / 2
    slack = 1 + SLACK * (F.col("q_top") + F.col("top") + gap * gap)
    rest = (armed.mapInArrow(_reach(centres), REACH).join(shapes, "pivot")
                 .filter(F.col("worst").isNull() | (bound + slack >= F.col("worst")))
                 .select("q_block", "block").join(home, ["q_block", "block"], "left_anti"))
    second = results(materialize(rest, "rest"), armed)
    best = materialize(_best(first.select("vec", F.inline("best")).unionByName(second), keep), "best")

    # A query's own row goes: the first entry with its id and its own square as score.
    own = F.struct(F.col("square").alias("score"), F.col("query_id").alias("vec_id"))
    answers = asked.join(best, "vec").withColumn("_at", F.array_position("best", own))
    others = F.slice(F.filter("best", lambda x, i: i + 1 != F.col("_at")), 1, k)
    return (answers.select("query_id", F.posexplode(others).alias("_i", "_x"))
                   .select("query_id", (F.col("_i") + 1).cast("int").alias("rank"), F.col("_x.vec_id").alias("vec_id"),
                           F.col("_x.score").alias("score")))
