"""Toxic spans by a linear-chain conditional random field.

Two states (0 clean, 1 toxic) per token.  A token's features are its whole
lower-cased form and its first 4, 5 and 6 bytes, each in a hashed table of
weights; neighbours are tied by transition weights.  Tokens are labelled from
document labels: a token of a toxic document counts as toxic if one of its
features is found in toxic training documents too often, against clean ones,
to be chance.  Training maximises the conditional likelihood with gradients
from forward-backward; marginals of the same recursion give offending spans
and, pooled, the score of a document.

The model is fitted on a bounded sample of labelled rows (``max_toxic`` +
``max_clean`` documents, drawn by a hash of their id) in one task, and has a
fixed size.  Scoring runs over all texts inside Spark tasks.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NOT_ALNUM, fold_case, prefix_sums, range_hash, slices, text_buffer, word_spans

BITS = 18
PREFIXES = (4, 5, 6)
FIELDS = 1 + len(PREFIXES)


def token_features(flat: np.ndarray, offsets: np.ndarray):
    """(feature buckets [FIELDS, tokens], starts, ends, first token of each row)."""
    starts, ends, first = word_spans(flat, offsets, NOT_ALNUM)
    sums = prefix_sums(fold_case(flat))
    shift = np.uint64(64 - BITS)
    out = np.empty((FIELDS, len(starts)), np.int32)
    out[0] = (range_hash(sums, starts, ends) >> shift).astype(np.int32)
    for k, n in enumerate(PREFIXES):
        out[k + 1] = (range_hash(sums, starts, np.minimum(starts + n, ends)) >> shift).astype(np.int32)
    return out, starts, ends, first


class Chains:
    """Token sequences of many rows laid out position by position.

    Place ``at[i]`` of token i lies in the stretch of its position; the longer
    rows come first, so the rows still running at position t are a prefix.
    """

    def __init__(self, first: np.ndarray):
        count = np.diff(first)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        longest = int(count.max()) if len(count) else 0
        ending = np.bincount(count, minlength=longest + 1)[:longest + 1]
        self.active = len(count) - np.cumsum(ending)[:longest]  # rows longer than t
        self.begin = np.concatenate([[0], np.cumsum(self.active)]).astype(np.int64)
        self.at = np.arange(int(first[-1] - first[0]), dtype=np.int32)
        self.at -= np.repeat(first[:-1].astype(np.int32), count)  # the position of each token
        self.at = self.begin.astype(np.int32)[self.at]
        self.at += np.repeat(rank.astype(np.int32), count)

    def marginals(self, odds: np.ndarray, trans: np.ndarray, start: float):
        """(P(state 1), expected transitions [2, 2], expected first states) from emission odds.

        ``odds`` are exp(emission of 1 - emission of 0) by place; ``trans`` the
        exponentials of transition weights.  In odds the forward step is
        u' = odds' (w01 + w11 u) / (w00 + w10 u), which cannot overflow.
        """
        w00, w01, w10, w11 = trans.ravel()
        n, b = self.active, self.begin
        u = np.empty_like(odds)
        v = np.ones_like(odds)
        steps = len(n)
        if steps:
            u[:b[1]] = odds[:b[1]] * start
        for t in range(1, steps):
            p, k = u[b[t - 1]:b[t - 1] + n[t]], slice(b[t], b[t + 1])
            u[k] = odds[k] * ((w01 + w11 * p) / (w00 + w10 * p))
        for t in range(steps - 2, -1, -1):
            k = slice(b[t + 1], b[t + 2])
            q = odds[k] * v[k]
            v[b[t]:b[t] + n[t + 1]] = (w10 + w11 * q) / (w00 + w01 * q)
        both = u * v
        both /= 1 + both
        return both, u, v

    def pair_counts(self, odds: np.ndarray, trans: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Expected number of each transition, [2, 2]."""
        n, b = self.active, self.begin
        if len(n) < 2:
            return np.zeros((2, 2))
        out = np.zeros(4)
        for lo in range(1, len(n), 256):  # some positions at a time, to bound memory
            hi = min(lo + 256, len(n))
            p = np.concatenate([u[b[t - 1]:b[t - 1] + n[t]] for t in range(lo, hi)]).astype(float)
            q = (odds[b[lo]:b[hi]] * v[b[lo]:b[hi]]).astype(float)
            cells = (lambda: trans[0, 0], lambda: trans[0, 1] * q, lambda: trans[1, 0] * p, lambda: trans[1, 1] * p * q)
            whole = np.full_like(p, trans[0, 0])
            for c in cells[1:]:  # one at a time: they are as long as the tokens
                whole += c()
            out += [(c() / whole).sum() for c in cells]
        return out.reshape(2, 2)


@dataclass
class Model:
    """Weights of the tagger and of the document score; fixed size."""

    bias: float = -6.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros((FIELDS, 1 << BITS), np.float32))
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0
    score: np.ndarray = field(default_factory=lambda: np.array([-3.0, 0.5, 0.5]))

    def odds(self, features: np.ndarray) -> np.ndarray:
        e = np.full(features.shape[1], self.bias, np.float32)
        for k in range(FIELDS):
            e += self.weights[k][features[k]]
        np.clip(e, -25, 25, out=e)
        return np.exp(e, out=e)

    def marginals(self, odds: np.ndarray, first: np.ndarray) -> np.ndarray:
        chains = Chains(first)
        placed = np.empty_like(odds)
        placed[chains.at] = odds
        m, _, _ = chains.marginals(placed, np.exp(self.trans), float(np.exp(self.start)))
        return m[chains.at]

    def pooled(self, m: np.ndarray, first: np.ndarray) -> np.ndarray:
        """[rows, 3]: one, the log odds of the likeliest token, the log of the expected toxic tokens."""
        rows = len(first) - 1
        top, total = np.zeros(rows), np.zeros(rows)
        full = np.flatnonzero(np.diff(first))
        if len(full):
            top[full] = np.maximum.reduceat(m, first[:-1][full])
            total[full] = np.add.reduceat(m.astype(float), first[:-1][full])
        top = np.clip(top, 1e-5, 1 - 1e-5)
        return np.stack([np.ones(rows), np.log(top / (1 - top)), np.log(total + 1e-3)], 1)

    def scores(self, m: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.pooled(m, first) @ self.score, -35, 35)))


def label_tokens(features: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """True for tokens of toxic documents with a feature that marks toxic documents.

    A feature marks them if it is found in so many toxic documents, and (but
    for one in fifty) in no clean one, that chance would not give one such
    feature in all (log odds of chance below minus the log of their number).
    Edited copies of one document are no independent finds: what counts is the
    number of documents or of different words before the feature, if smaller.
    """
    row = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
    n1, n0 = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    rarity = np.log((n1 + n0) / n1)
    before = np.concatenate([[-1], features[0][:-1]])
    before[first[:-1][np.diff(first) > 0]] = -1

    def found(feature: np.ndarray, where: np.ndarray, side: np.ndarray) -> np.ndarray:
        pair = where[side].astype(np.int64)
        pair += 1
        pair <<= BITS
        pair |= feature[side]
        pair.sort()
        pair = pair[np.diff(pair, prepend=-1) != 0]
        pair &= (1 << BITS) - 1
        return np.bincount(pair, minlength=1 << BITS)

    marked = np.zeros(features.shape[1], bool)
    side = toxic[row]
    for f in features:
        in1 = np.minimum(found(f, row, side), found(f, before, side))
        in0 = found(f, row, ~side)
        kinds = np.count_nonzero(np.bincount(f, minlength=1 << BITS))
        marks = (in1 * rarity >= np.log(max(kinds, 1)) + 4) & (in0 / n0 <= 0.02 * in1 / n1)
        marked |= marks[f]
    return marked & side


def fit(texts: list[str], toxic: np.ndarray, rounds: int = 40, rate: float = 0.5,
        decay: float = 1e-6) -> Model:
    """CRF and document score from whole labelled texts (a bounded sample).

    Beside the features (16 bytes a token) a token holds a few numbers; what
    is made of all tokens is freed before the next of its kind is made.
    """
    model = Model()
    toxic = np.asarray(toxic, bool)
    if not len(texts) or toxic.all() or not toxic.any():
        if len(texts):
            model.score = np.array([3.0 if toxic.all() else -3.0, 0.0, 0.0])
        return model
    column = pa.array(texts, pa.large_string())
    flat, offsets = text_buffer(column)
    parts = []
    for a, b in slices(offsets):
        f, _, _, own = token_features(flat[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        parts.append((f, np.diff(own)))
    first = np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]))])
    features = np.empty((FIELDS, first[-1]), np.int32)
    at = first[-1]
    while parts:
        f, _ = parts.pop()
        features[:, at - f.shape[1]:at] = f
        at -= f.shape[1]
    del column, flat, f
    y = label_tokens(features, first, toxic)
    chains = Chains(first)
    heads = first[:-1][np.diff(first) > 0]
    follows = np.ones(len(y), bool)  # not the first of its row
    follows[heads] = False
    step = (2 * y[:-1].astype(np.int8) + y[1:])[follows[1:]]
    pairs = np.array([[np.count_nonzero(step == 2 * a + b) for b in (0, 1)] for a in (0, 1)], float)
    del step, follows
    # Buckets that do not occur have no gradient; steps are Adagrad's.
    seen = [np.full(1 << BITS, 1e-8) for _ in features]
    g2 = {"bias": 1e-8, "trans": np.full((2, 2), 1e-8), "start": 1e-8}
    n = max(len(y), 1)
    scale = 1.0 / max(float(y.sum()), 1.0)
    for _ in range(rounds):
        placed = np.empty(len(y), np.float32)
        placed[chains.at] = model.odds(features)
        w = np.exp(model.trans)
        m, u, v = chains.marginals(placed, w, float(np.exp(model.start)))
        counts = chains.pair_counts(placed, w, u, v)
        del placed, u, v
        m = m[chains.at]
        gap = np.subtract(y, m, dtype=float)
        gap *= scale
        del m
        for k, f in enumerate(features):
            g = np.bincount(f, gap, 1 << BITS) - decay * model.weights[k]
            seen[k] += g * g
            model.weights[k] += (rate * g / np.sqrt(seen[k])).astype(np.float32)
        g = gap.sum()
        g2["bias"] += g * g
        model.bias += rate * g / np.sqrt(g2["bias"])
        g = (pairs - counts) * scale
        g[0, 0] = 0.0  # the reference cell
        g2["trans"] += g * g
        model.trans += rate * g / np.sqrt(g2["trans"])
        g = gap[heads].sum()
        g2["start"] += g * g
        model.start += rate * g / np.sqrt(g2["start"])
        del gap
    m = model.marginals(model.odds(features), first)
    x, t = model.pooled(m, first), toxic.astype(float)
    c = np.zeros(3)
    for _ in range(25):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ c, -35, 35)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        c += np.linalg.solve(h, x.T @ (t - p) - 1e-2 * c)
    model.score = c
    return model


def draw_sample(docs: DataFrame, labels: DataFrame, max_toxic: int, max_clean: int) -> DataFrame:
    """At most so many labelled rows (draw, doc_id, text, toxic): those whose id hashes lowest, for each label.

    Ids are chosen from the labels alone; only the chosen ids (bounded by the
    two limits) are broadcast to the scan of the texts.  Of rows that repeat an
    id the least text counts, so the sample stays within its limits.
    """
    known = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
                   .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
                   .withColumn("draw", F.md5(F.col("doc_id").cast("string"))))
    ids = (known.filter("toxic = 1").orderBy("draw", "doc_id").limit(max_toxic)
                .unionByName(known.filter("toxic = 0").orderBy("draw", "doc_id").limit(max_clean)))
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
                .groupBy("draw", "doc_id", "toxic").agg(F.min("text").alias("text"))
                .select("draw", "doc_id", "text", "toxic"))


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a sample to one row: the model, as bytes."""
    rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))),
                  key=lambda r: (r[0], r[1], r[2] or ""))
    seen: dict[str, bool] = {}
    for _, _, text, toxic in rows:  # equal texts count once
        seen.setdefault(text or "", toxic == 1)
    del rows
    model = fit(list(seen), np.array(list(seen.values()), bool))
    yield pa.record_batch([pa.array([zlib.compress(pickle.dumps(model), 1)], pa.binary())], ["model"])


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = 1000, max_clean: int = 2000) -> Model:
    """A model from at most ``max_toxic`` and ``max_clean`` labelled documents.

    The sample's rows meet in one task, bounded by the two limits; the driver
    gets the weights.
    """
    sample = draw_sample(docs, labels, max_toxic, max_clean)
    row = sample.repartition(1).mapInArrow(_fit_rows, "model binary").first()
    return pickle.loads(zlib.decompress(row[0])) if row else Model()


#: Bytes of text whose chains are run together in a task.
CHAIN_BYTES = 4 << 20


def _marginals(model: Model, flat: np.ndarray, offsets: np.ndarray, spans: bool):
    """(marginal of each token, first token of each row, token places if asked for)."""
    odds, firsts, places = [np.zeros(0, np.float32)], [np.zeros(1, np.int64)], []
    for lo, hi in slices(offsets):
        f, s, e, first = token_features(flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        odds.append(model.odds(f))
        firsts.append(firsts[-1][-1] + first[1:])
        if spans:
            row = np.repeat(np.arange(lo, hi), np.diff(first))
            back = offsets[lo] - offsets[row]
            places.append((s + back, e + back))
    first = np.concatenate(firsts)
    return model.marginals(np.concatenate(odds), first), first, places


def _scorer(model: Model, spans: bool):
    """Arrow function: the columns before the last, with the score of the last one's texts (and spans)."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, offsets = text_buffer(b.column(b.num_columns - 1))
            names = [*b.schema.names[:-1], "score", *(["spans"] if spans else [])]
            for lo, hi in slices(offsets, CHAIN_BYTES):
                m, first, places = _marginals(model, flat[offsets[lo]:offsets[hi]],
                                              offsets[lo:hi + 1] - offsets[lo], spans)
                columns = [*(c.slice(lo, hi - lo) for c in b.columns[:-1]),
                           pa.array(model.scores(m, first), pa.float64())]
                yield pa.record_batch([*columns, *([_span_lists(m, first, places)] if spans else [])], names)

    return score


def _span_lists(m: np.ndarray, first: np.ndarray, places) -> pa.Array:
    """Per row the byte ranges of maximal runs of tokens that are toxic rather than not."""
    s = np.concatenate([p[0] for p in places]) if places else np.zeros(0, np.int64)
    e = np.concatenate([p[1] for p in places]) if places else np.zeros(0, np.int64)
    on = m >= 0.5
    head = np.zeros(len(m) + 1, bool)
    head[first] = True
    begin = on.copy()
    begin[1:] &= ~on[:-1] | head[1:-1]
    last = on.copy()
    last[:-1] &= ~on[1:] | head[1:-1]
    i, j = np.flatnonzero(begin), np.flatnonzero(last)
    items = pa.StructArray.from_arrays([pa.array(s[i]), pa.array(e[j])], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(i, first).astype(np.int32)), items)


def score(docs: DataFrame, model: Model, spans: bool = True, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1) and, if asked for, toxic ``spans``.

    A span is a byte range of the text's UTF-8.  Null and empty texts have no
    tokens, get the score of a document without toxic tokens and no spans;
    repeated rows and null ids are scored like others; other columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, score double" + (", spans array<struct<start:bigint,end:bigint>>" if spans else "")
    return rows.mapInArrow(_scorer(model, spans), schema)


def reject(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more; all columns stay as they are."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.names.index(text_col)
            flat, offsets = text_buffer(b.column(at))
            for lo, hi in slices(offsets, CHAIN_BYTES):
                m, first, _ = _marginals(model, flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], False)
                yield b.slice(lo, hi - lo).filter(pa.array(model.scores(m, first) < threshold))

    return docs.mapInArrow(keep, docs.schema)


def held_out(id_col: str = "doc_id", folds: int = 5):
    """True for the fold of ids that is never learnt from; a null id has no fold (false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def train_and_score(docs: DataFrame, labels: DataFrame, spans: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted (and spans) of all documents; learns outside the held-out fold."""
    model = train(docs, labels.filter(~held_out()))
    out = score(docs, model, spans)
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      *(["spans"] if spans else []))
