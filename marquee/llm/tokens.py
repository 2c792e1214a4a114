"""Token ids of whole documents, vectorised per Arrow batch.

The vocabulary splits texts at white space, and between ASCII letters or
digits and ASCII punctuation (the apostrophe aside, which starts
contractions), before anything else.  So a document's ids are the ids of such
chunks in turn.  Each distinct chunk is encoded once per worker (the
tokenizers library does the encoding) and looked up by its hash from then on;
the table of known chunks starts afresh once it holds ``KNOWN_CHUNKS``, so a
worker's memory is bounded.
"""

from __future__ import annotations

import os

import numpy as np

from .common import BASE_B, SPACE, fold_case, mix, prefix_sums, range_hash

#: Chunks that a worker remembers; then it starts afresh (memory, not results).
KNOWN_CHUNKS = 600_000
#: A chunk of its own between chunks that are encoded together, and how many are.
MARK, TOGETHER = "\x01", 100

#: 0 white space, 1 ASCII letters and digits, 2 ASCII punctuation but the apostrophe, 3 the rest.
_KIND = np.full(256, 3, np.uint8)
_KIND[33:127] = 2
_KIND[39] = 3
_KIND[48:58] = _KIND[65:91] = _KIND[97:123] = 1
_KIND[SPACE] = 0


def chunk_spans(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of chunks, and the first chunk of each row."""
    kind = _KIND[flat]
    apart = np.ones(len(flat) + 1, bool)  # a chunk cannot go on across this place
    if len(flat):
        before, after = kind[:-1], kind[1:]
        apart[1:-1] = (before == 0) | (after == 0) | (before + after == 3) & (before != 0) & (after != 0)
    apart[offsets] = True
    ink = kind != 0
    starts = np.flatnonzero(ink & apart[:-1])
    ends = np.flatnonzero(ink & apart[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_LOADED: dict[str, "ChunkTokenizer"] = {}


def tokenizer_at(path: str) -> "ChunkTokenizer":
    """The worker's tokenizer of this file, with the chunks it has met so far."""
    if path not in _LOADED:
        _LOADED[path] = ChunkTokenizer(path)
    return _LOADED[path]


class ChunkTokenizer:
    """Ids of texts by a tokenizers file whose ids do not cross white space.

    Special strings in a text are ordinary text.  Upper and lower case share
    their ids in such a vocabulary, so chunks are known by their lower case.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.mark = self._encode([MARK])[0]
        self._clear()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_chunks(self, chunks: list[str]) -> list[np.ndarray]:
        """Ids of each chunk; many are encoded as one text with marks between them."""
        plain = [i for i, c in enumerate(chunks) if MARK not in c]
        out: list[np.ndarray | None] = [None] * len(chunks)
        if len(self.mark) == 1:
            runs = [plain[i:i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
            for run, ids in zip(runs, self._encode([f" {MARK} ".join(chunks[i] for i in r) for r in runs])):
                ids = np.array(ids, np.uint32)
                marks = np.flatnonzero(ids == self.mark[0])
                for i, a, b in zip(run, [0, *(marks + 1)], [*marks, len(ids)]):
                    out[i] = ids[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._encode([chunks[i] for i in rest])):
            out[i] = np.array(ids, np.uint32)
        return out

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, chunks: list[str]) -> None:
        if len(self.keys) + len(keys) > KNOWN_CHUNKS:
            self._clear()
        found = self._encode_chunks(chunks)
        count = np.fromiter(map(len, found), np.int64, len(found))
        begin = len(self.ids) + np.concatenate([[0], np.cumsum(count)[:-1]]).astype(np.int64)
        flat = np.concatenate(found) if found else np.zeros(0, np.uint32)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, begin)
        self.count = np.insert(self.count, at, count)
        self.ids = np.concatenate([self.ids, flat])

    def encode(self, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, begin of each row's ids) for texts given as bytes and offsets."""
        starts, ends, first = chunk_spans(flat, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        lower = fold_case(flat)
        # One key from two hashes of independent bases.
        key = mix(range_hash(prefix_sums(lower), starts, ends)
                  + range_hash(prefix_sums(lower, BASE_B), starts, ends, BASE_B))
        distinct, where, which = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > KNOWN_CHUNKS:
            self._clear()
        at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        new = np.ones(len(distinct), bool) if not len(self.keys) else self.keys[at] != distinct
        if new.any():
            data = flat.tobytes()
            spans = zip(starts[where[new]].tolist(), ends[where[new]].tolist())
            self._learn(distinct[new], [data[a:b].decode("utf-8", "replace") for a, b in spans])
        at = np.searchsorted(self.keys, distinct)[which]
        count, begin = self.count[at], self.begin[at]
        upto = np.concatenate([[0], np.cumsum(count)])
        take = np.repeat(begin - upto[:-1], count) + np.arange(upto[-1])
        return self.ids[take], upto[first]
