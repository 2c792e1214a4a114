"""Helpers shared by the operators: columns, cut lineage, Arrow bytes, word hashes.

The array helpers work on one Arrow batch (or a slice of it) inside a task.
They see whole texts as one byte buffer plus offsets, so a batch of thousands
of documents costs a few vectorised passes and no Python loop per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root, scratch_path

U64 = np.uint64
#: Odd multipliers of the polynomial hashes (any odd 64-bit constants do).
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: Bytes that one vectorised pass takes at a time; a pass holds some 50 times as many, and its worker keeps part of that.
SLICE_BYTES = 1 << 18

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(col):
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, LOWER)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (whatever the case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage with files that survive a lost executor; non-deterministic
    inputs (range bounds, Python partitions) are thereby fixed as well.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    root = checkpoint_root(spark).split(":", 1)[-1].lstrip("/")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if root in f and "/llm-" in f:
            path = jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(conf).delete(path, True)


# --- bytes of a batch -------------------------------------------------------

def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type)
                                  or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offs = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offs = offs[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if len(offs) == 0:
        offs = np.zeros(1, np.int64)
    return flat[offs[0]:offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges (a, b) of about ``limit`` bytes each; a longer row stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (a bijection with good avalanche)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0xC2B2AE3D27D4EB4F))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: All ASCII but letters and digits; what is left are words without punctuation.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[128:] = NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = False
_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = BASE_A) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of ``base`` and of its inverse modulo 2**64 (kept per process)."""
    have = _POWERS.get((base, 0))
    if have is None or len(have[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 4096)
        up = np.full(size, base, U64)
        down = np.full(size, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        have = _POWERS[(base, 0)] = (np.cumprod(up), np.cumprod(down))
    return have


def prefix_sums(flat: np.ndarray, base: int = BASE_A) -> np.ndarray:
    """Prefix sums whose differences are polynomial hashes of byte ranges."""
    up, _ = powers(len(flat), base)
    out = np.zeros(len(flat) + 1, U64)
    np.cumsum(_BYTE_CODE[flat] * up[:len(flat)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, a: np.ndarray, b: np.ndarray, base: int = BASE_A) -> np.ndarray:
    """64-bit hashes of the byte ranges [a, b); equal bytes, equal hash."""
    _, down = powers(len(sums), base)
    return mix((sums[b] - sums[a]) * down[a] + (b - a).astype(U64))


def fold_case(flat: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, byte by byte (UTF-8 stays valid)."""
    return _FOLD[flat]


def word_spans(flat: np.ndarray, offsets: np.ndarray,
               apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes not ``apart``): their starts, ends, and the first word of each row.

    Row r has the words first[r] .. first[r + 1] - 1.  Words end with their row.
    """
    word = ~apart[flat]
    edge = np.zeros(len(flat) + 1, bool)  # a row begins here
    edge[offsets] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:-1]
    starts = np.flatnonzero(begin)
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    ends = np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, first word of each row)."""
    starts, ends, first = word_spans(flat, offsets)
    return range_hash(prefix_sums(fold_case(flat)), starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each shingle of ``width`` words, first shingle of each row).

    A row with fewer words, but some, has its whole sequence as one shingle;
    a row without words has none.
    """
    count = np.diff(first)
    made = np.where(count >= width, count - width + 1, (count > 0).astype(count.dtype))
    row = np.repeat(np.arange(len(count)), made)
    begin = np.concatenate([[0], np.cumsum(made)]).astype(np.int64)
    at = np.arange(len(row)) - begin[row] + first[row] if len(row) else np.zeros(0, np.int64)
    length = np.minimum(count[row], width)
    out = length.astype(U64)
    for j in range(width):
        use = j < length
        w = words[np.minimum(at + j, max(len(words) - 1, 0))] if len(words) else np.zeros(0, U64)
        out = np.where(use, mix(out * U64(BASE_B) + w), out)
    return out, begin


def as_signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def list_array(values: np.ndarray, begin: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values, kind))
