"""Packing of token sequences: bounded-space online best fit.

Each partition of the input keeps a fixed number of open windows.  A document
longer than a window fills whole windows first; its last piece (or the whole
document, if it fits) goes into the open window that it fills best.  If it
fits none and all are in use, the fullest is emitted to make room.  Windows
still open at the end of a partition are merged across partitions in rounds,
by the same rule with whole windows as the items, so no task ever holds more
than a few hundred of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, materialize, slices, text_buffer
from .tokens import tokenizer_at

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary, is_open boolean")


class OpenWindows:
    """At most ``limit`` open windows of ``size`` tokens and how full each is; best fit."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.used: dict[int, int] = {}

    def place(self, length: int, fresh: int) -> tuple[int, int, list[int]]:
        """(window, offset, windows that close) for an item; ``fresh`` names a new window."""
        closed = []
        fits = [(u, -w) for w, u in self.used.items() if u + length <= self.size]
        if fits:
            at, window = max(fits)
            window = -window
        else:
            if len(self.used) >= self.limit:
                closed.append(max(self.used, key=self.used.__getitem__))
                del self.used[closed[0]]
            window, at = fresh, 0
        self.used[window] = at + length
        if at + length == self.size:
            del self.used[window]
            closed.append(window)
        return window, at, closed


def _packer(path: str, size: int, limit: int, end_id: int, with_ids: bool):
    """The Arrow function of one partition: batches (doc_id, text) to pieces."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = (TaskContext.get().partitionId()) << 40
        tokenizer = tokenizer_at(path)
        count = 0
        held: dict[int, list[tuple]] = {}  # pieces of the open windows
        ready: list[tuple] = []
        windows = OpenWindows(size, limit)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32",
                                "doc_tokens", "sequence_id", "offset")]
                               + [("ids", pa.binary()), ("is_open", pa.bool_())])
            cols = list(zip(*rows)) or [[]] * len(schema)
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema)

        for b in batches:
            doc_ids = b.column(0).to_pylist()
            flat, offsets = text_buffer(b.column(1))
            for lo, hi in slices(offsets, SLICE_BYTES):
                a, z = offsets[lo], offsets[hi]
                ids, begin = tokenizer.encode(flat[a:z], offsets[lo:hi + 1] - a)
                for r in range(hi - lo):
                    own = ids[begin[r]:begin[r + 1]]
                    own = np.append(own, np.uint32(end_id)).astype("<u4")
                    n = len(own)
                    for s in range(0, n, size):
                        part = own[s:s + size]
                        data = part.tobytes()
                        w, at, closed = windows.place(len(part), count)
                        count += w == count
                        held.setdefault(w, []).append((
                            doc_ids[lo + r], s, len(part), zlib.crc32(data), n, task + w, at,
                            data if with_ids else None))
                        ready.extend((*p, False) for c in closed for p in held.pop(c))
                if len(ready) >= 500:
                    yield batch(ready)
                    ready = []
        ready.extend((*p, True) for w in held for p in held[w])
        yield batch(ready)

    return pieces


def _merge_group(size: int):
    """pandas function of one merge group: open windows to merged windows (numbers and offsets)."""

    def merge(key, pdf):
        pdf = pdf.sort_values(["used", "sequence_id"], ascending=[False, True], ignore_index=True)
        target, offset = [], []
        windows = OpenWindows(size, len(pdf) + 1)
        for k, (seq, n) in enumerate(zip(pdf["sequence_id"], pdf["used"])):
            w, at, _ = windows.place(int(n), k)
            target.append(pdf["sequence_id"][w])
            offset.append(at)
        pdf["target"], pdf["shift"] = target, offset
        return pdf[["sequence_id", "target", "shift"]]

    return merge


#: Partitions whose open windows one merge task takes together.
MERGE_FAN_IN = 16


def pack(docs: DataFrame, vocabulary: str, size: int = 4096, open_windows: int = 16, end_id: int = 2,
         with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of sequences of at most ``size`` tokens: one row per piece.

    Columns: doc_id, start (ids of the document before the piece), length,
    ids_crc32, doc_tokens (with ``end_id``), sequence_id, offset (gapless from
    0) and ids (little-endian unsigned 32-bit, if ``with_ids``).

    Sequences of a partition are full, or the fullest of ``open_windows`` when
    emitted; what stays open is at most ``open_windows`` per partition, and
    merge rounds join those of ``MERGE_FAN_IN`` partitions at a time until one
    round has a single group.

    Defined cases: a null or empty text is its end token alone; a null id is
    packed under null; repeated rows are packed as often as they come; an
    empty table gives no rows; further columns are ignored; ``vocabulary`` is
    the path of a tokenizers file that every executor can read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = materialize(rows.mapInArrow(_packer(vocabulary, size, open_windows, end_id, with_ids),
                                         PIECES), "pieces")
    closed = pieces.filter(~F.col("is_open")).drop("is_open")
    opened = pieces.filter("is_open").drop("is_open")
    last = opened.agg(F.max(F.shiftright("sequence_id", 40))).first()[0]
    # Where each open window ends up: (sequence_id, target, shift), by rounds.
    moves = opened.groupBy("sequence_id").agg(F.sum("length").alias("used")).select(
        "sequence_id", F.col("sequence_id").alias("target"), F.lit(0).cast("long").alias("shift"), "used")
    group, groups, small = F.shiftright("sequence_id", 40), (last or 0) + 1, size
    while True:
        group, groups = F.floor(group / MERGE_FAN_IN), -(-groups // MERGE_FAN_IN)
        # Of a merged group at most one window is less than half full; only those go on.
        state = (moves.groupBy(F.col("target").alias("sequence_id")).agg(F.sum("used").alias("used"))
                      .filter(F.col("used") <= small).withColumn("_group", group))
        step = (state.groupBy("_group")
                     .applyInPandas(_merge_group(size), "sequence_id long, target long, shift long")
                     .select(F.col("sequence_id").alias("_from"), F.col("target").alias("_to"),
                             F.col("shift").alias("_by")))
        moves = materialize(
            moves.join(step, moves["target"] == step["_from"], "left")
                 .select("sequence_id", F.coalesce("_to", "target").alias("target"),
                         (F.col("shift") + F.coalesce("_by", F.lit(0))).alias("shift"), "used"), "moves")
        if groups <= 1:
            break
        small = size // 2
    placed = opened.join(moves, "sequence_id").withColumn("offset", F.col("offset") + F.col("shift")) \
                   .withColumn("sequence_id", F.col("target")).select(closed.columns)
    out = closed.unionByName(placed)
    return out if with_ids else out.drop("ids")
