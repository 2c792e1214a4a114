"""Prefix trie of conversations, as balanced parentheses over blocks of sorted paths.

A conversation is a path of turns, a turn a 128-bit digest of role and text.
Paths are cut in bands of ``BAND`` turns, so a conversation of any length is
rows of bounded size; a piece of a lower band hangs under a root that is named
by a hash of all turns before it.  Equal pieces are one row with a count before
anything is sorted, so a group of copies is one row.

Distinct pieces are range-sorted; each block of at most ``BLOCK`` of them is one
shard of the trie.  Its nodes are written as balanced parentheses: findclose,
by blocks of minimal excess in a min-max tree, delimits a node's subtree; the
rank of leaf pairs ``()`` counts its leaves, a cumulative array over nodes in
preorder its savings, one over paths its members.  Only the nodes on a block's
first and last path (its spines) can go on in another block: those return sums
over what hangs beside the spine, and are merged by name.  The totals of lower
bands are added along the root chains by doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE_A, BASE_B, U64, discard, materialize, mix

#: Turns of a piece, distinct pieces of a block, ids that one row of the member digests joins.
BAND, BLOCK, JOINED = 64, 4096, 4096
DIGEST = 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


# --- running sums over range-sorted rows ----------------------------------------------

def running_sums(rows: DataFrame, key: str, order: list[str], values: list[str], name: str) -> DataFrame:
    """``rows`` with ``before_<v>``: sum, modulo 2**64, of v over the earlier rows of the same key.

    ``order`` starts with ``key`` (long, never null).  Rows are sorted by range,
    so a key with much of the rows lies in many partitions; each partition sums
    its own rows, and one row per partition carries the sums on.
    """
    out = T.StructType([*rows.schema.fields, *[T.StructField(f"before_{v}", T.LongType()) for v in values],
                        T.StructField("_part", T.LongType()), T.StructField("_first", T.LongType()),
                        T.StructField("_last", T.BooleanType())])
    at, columns = rows.columns.index(key), [rows.columns.index(v) for v in values]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, first, now, carry, held = TaskContext.get().partitionId(), None, None, [U64(0)] * len(values), None
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                yield held
            keys = np.asarray(b.column(at))
            first = int(keys[0]) if first is None else first
            head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            run = np.searchsorted(head, np.arange(len(keys)), "right") - 1
            more = []
            for j, c in enumerate(columns):
                v = np.asarray(b.column(c)).astype(np.int64).view(U64)
                upto = np.cumsum(v)
                before = upto - v
                before = before - before[head][run]
                if now == int(keys[0]):
                    before[run == 0] += carry[j]
                carry[j] = (before[-1:] + v[-1:])[0]
                more.append(pa.array(before.view(np.int64)))
            now = int(keys[-1])
            n = len(keys)
            held = pa.record_batch([*b.columns, *more, pa.array(np.full(n, part, np.int64)),
                                    pa.array(np.full(n, first, np.int64)),
                                    pa.array(np.zeros(n, bool))], names=out.names)
        if held is not None:
            mark = np.zeros(held.num_rows, bool)
            mark[-1] = True
            yield pa.record_batch([*held.columns[:-1], pa.array(mark)], names=out.names)

    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    local = materialize(sorted_rows.mapInArrow(sums, out), name)
    carries: dict[int, list[int]] = {}
    before, total = None, [0] * len(values)
    # One row of each partition of the sort.
    for r in sorted(local.filter("_last").select("_part", "_first", key, *values, *[f"before_{v}" for v in values])
                         .collect(), key=lambda r: r["_part"]):
        carry = total if before == r["_first"] else [0] * len(values)
        if any(carry):
            carries[r["_part"]] = carry
        whole = carry if r[key] == r["_first"] else [0] * len(values)
        total = [(r[f"before_{v}"] + r[v] + w) % (1 << 64) for v, w in zip(values, whole)]
        before = r[key]
    final = T.StructType(out.fields[:-3])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols, n = list(b.columns), len(final)
            keys, part, first = (np.asarray(b.column(c)) for c in (at, n, n + 1))
            for p in np.unique(part):
                if int(p) in carries:
                    mine = (part == p) & (keys == first)
                    for j, c in enumerate(carries[int(p)]):
                        v = np.asarray(cols[n - len(values) + j]).astype(np.int64).view(U64)
                        v[mine] += U64(c)
                        cols[n - len(values) + j] = pa.array(v.view(np.int64))
            yield pa.record_batch(cols[:n], names=final.names)

    return local.mapInArrow(add, final)


# --- turns --------------------------------------------------------------------------

def placed_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv_id, place from 0, digest, chars) of every turn that has a conversation.

    Turns are ordered by number, null first; equal numbers by role, then by the
    SHA-256 of the text.  ``digest`` stands for role and text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turn = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.sha2(text, 256).alias("text_sha256"), F.unhex(F.substr(turn, F.lit(1), F.lit(2 * DIGEST))).alias("digest"),
        F.length(text).cast("long").alias("chars"), F.lit(1).cast("long").alias("one"))
    order = ["conv_id", "turn", "role", "text_sha256"]
    return materialize(running_sums(rows, "conv_id", order, ["one"], "turns").select(
        "conv_id", F.col("before_one").alias("place"), "digest", "chars"), "placed")


def shared_heads(placed: DataFrame, span: int, most: int) -> DataFrame:
    """(conv_id, n, place, digest, chars) of rebuilt conversations; one row with a null place where there are no turns.

    Conversation c begins with the first h turns of conversation c - c % span
    (all if fewer, none if absent) and goes on with its own after its first h,
    h being crc32 of its decimal id, modulo ``most`` (c % span has the sign of c,
    as in SQL).  n is the turns it has then.
    """
    own = materialize(placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")), "lengths")
    base = F.col("conv_id") - F.col("conv_id") % span
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids = own.withColumn("_base", base).withColumn("_h", h)
    bases = own.filter(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("_base"),
                                                            F.col("own").alias("_has"))
    taken = F.least("_h", F.coalesce("_has", F.lit(0)))
    known = (ids.join(bases, "_base", "left").withColumn("_taken", taken)
                .withColumn("n", F.col("_taken") + F.greatest(F.col("own") - F.col("_h"), F.lit(0))))
    known = materialize(known.select("conv_id", "_base", "_h", "_taken", "n"), "rebuilt")
    # At most ``most`` - 1 turns of a base, for at most two spans of conversations.
    heads = placed.filter((F.col("conv_id") % span == 0) & (F.col("place") < most - 1)).select(
        F.col("conv_id").alias("_base"), "place", "digest", "chars")
    begun = known.join(heads, "_base").filter(F.col("place") < F.col("_taken"))
    rest = placed.join(known, "conv_id").filter(F.col("place") >= F.col("_h"))
    columns = ("conv_id", "n", "place", "digest", "chars")
    moved = rest.withColumn("place", F.col("place") - F.col("_h") + F.col("_taken"))
    bare = known.filter("n = 0").select("conv_id", "n", F.lit(None).cast("long").alias("place"),
                                        F.lit(None).cast("binary").alias("digest"),
                                        F.lit(None).cast("long").alias("chars"))
    return begun.select(*columns).unionByName(moved.select(*columns)).unionByName(bare)


# --- pieces -------------------------------------------------------------------------

def _powers_at(exponents: np.ndarray, base: int) -> np.ndarray:
    """base ** exponent modulo 2**64."""
    out, square, left = np.ones(len(exponents), U64), U64(base), exponents.astype(np.int64)
    while (left > 0).any():
        out = np.where(left & 1 == 1, out * square, out)
        square, left = square * square, left >> 1
    return out


def _terms(path: bytes, begin: int) -> tuple[int, int]:
    """What a piece adds to the two hashes of its conversation's turns; ``begin`` is the place of its first turn."""
    codes = np.frombuffer(path, "<u8").reshape(-1, 2)
    at = np.arange(begin, begin + len(codes))
    return tuple(int((mix(codes[:, j] + U64(j + 1)) * _powers_at(at, base)).sum(dtype=U64))
                 for j, base in enumerate((BASE_A, BASE_B)))


def _signed(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def _root(band: int, a: int, b: int) -> bytes:
    """Name of the root of a band: the hashes of all turns before it."""
    return hashlib.blake2b(b"%d,%d,%d" % (band, a, b), digest_size=DIGEST).digest()


def _child(name: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(name + turn, digest_size=DIGEST).digest()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with ``ea`` and ``eb``, their terms of the hashes."""
    for b in batches:
        bands, paths = b.column("band").to_pylist(), b.column("path").to_pylist()
        terms = [_terms(p, k * BAND) for k, p in zip(bands, paths)]
        yield pa.record_batch([*b.columns, *[pa.array([_signed(t[j]) for t in terms], pa.int64()) for j in (0, 1)]],
                              names=[*b.schema.names, "ea", "eb"])


def _pieces(turns: DataFrame) -> DataFrame:
    """(conv_id, n, band, path, chars, ha, hb): pieces of at most ``BAND`` turns and the hashes of what is before them."""
    band = F.coalesce(F.floor(F.col("place") / BAND), F.lit(0)).alias("band")
    some = F.col("place").isNotNull()
    listed = F.sort_array(F.collect_list(F.when(some, F.struct("place", "digest", "chars"))))
    rows = turns.groupBy("conv_id", "n", band).agg(listed.alias("_t"))
    blank = F.lit("").cast("binary")
    # Characters as fixed-width hex, so that equal paths are equal keys of a plain hash aggregate.
    path = F.aggregate("_t", blank, lambda acc, t: F.concat(acc, t["digest"]))
    chars = F.aggregate("_t", blank, lambda acc, t: F.concat(acc, F.unhex(F.lpad(F.hex(t["chars"]), 16, "0"))))
    rows = materialize(rows.select("conv_id", "n", "band", path.alias("path"), chars.alias("chars")), "pieces")
    short = rows.filter(F.col("n") <= BAND).withColumns({"ha": F.lit(0).cast("long"), "hb": F.lit(0).cast("long")})
    schema = T.StructType([*rows.schema.fields, T.StructField("ea", T.LongType()), T.StructField("eb", T.LongType())])
    deep = running_sums(rows.filter(F.col("n") > BAND).mapInArrow(_hashed, schema), "conv_id", ["conv_id", "band"],
                        ["ea", "eb"], "deep")
    deep = deep.select(*rows.columns, F.col("before_ea").alias("ha"), F.col("before_eb").alias("hb"))
    return materialize(short.unionByName(deep), "hashed")


# --- balanced parentheses ---------------------------------------------------------------

class Parentheses:
    """A balanced sequence with findclose by a min-max tree over blocks of excess."""

    WIDTH = 64

    def __init__(self, opens: np.ndarray):
        self.excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int64)
        blocks = -(-len(opens) // self.WIDTH)
        self.leaves = 1 << max(blocks - 1, 0).bit_length()
        filled = np.full(self.leaves * self.WIDTH, np.iinfo(np.int64).max)
        filled[:len(opens)] = self.excess
        self.filled = filled
        self.least = np.full(2 * self.leaves, np.iinfo(np.int64).max)
        self.least[self.leaves:] = filled.reshape(self.leaves, self.WIDTH).min(axis=1)
        level = self.leaves
        while level > 1:
            self.least[level // 2:level] = self.least[level:2 * level].reshape(-1, 2).min(axis=1)
            level //= 2

    def _scan(self, at: np.ndarray, want: np.ndarray) -> np.ndarray:
        """The first place from ``at`` on, in its block, with excess ``want`` or less; else the block's end."""
        at = at.copy()
        live = np.flatnonzero(at % self.WIDTH != 0)
        fresh = np.flatnonzero(at % self.WIDTH == 0)
        # A block's first place needs no scan to know whether the block is entered at its start.
        live = np.concatenate([live, fresh])
        first = np.ones(len(at), bool)
        while len(live):
            inside = first[live] | (at[live] % self.WIDTH != 0)
            live = live[inside]
            live = live[self.filled[np.minimum(at[live], len(self.filled) - 1)] > want[live]]
            at[live] += 1
            first[live] = False
        return at

    def findclose(self, opened: np.ndarray) -> np.ndarray:
        """For each opening place the place that closes it."""
        want = self.excess[opened] - 1
        at = opened + 1
        begin = at.copy()
        at = self._scan(at, want)
        done = (at < len(self.filled)) & ((at % self.WIDTH != 0) | (at == begin))
        done &= self.filled[np.minimum(at, len(self.filled) - 1)] <= want
        rest = np.flatnonzero(~done)
        node = self.leaves + begin[rest] // self.WIDTH + 1
        goal = want[rest]
        up = np.flatnonzero(self.least[np.minimum(node, 2 * self.leaves - 1)] > goal)
        while len(up):  # to the next node on the right, as high as it can be taken whole
            node[up] = (node[up] + (node[up] & 1)) >> 1
            up = up[self.least[node[up]] > goal[up]]
        down = np.flatnonzero(node < self.leaves)
        while len(down):
            node[down] *= 2
            node[down] += self.least[node[down]] > goal[down]
            down = down[node[down] < self.leaves]
        at[rest] = self._scan((node - self.leaves) * self.WIDTH, goal)
        return at


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of values[lo:hi], each range with one value at least."""
    table = [values]
    while (1 << len(table)) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1
    out = np.empty(len(lo), values.dtype)
    for k in np.unique(level):
        m = level == k
        out[m] = np.minimum(table[k][lo[m]], table[k][hi[m] - (1 << int(k))])
    return out


NODE = T.StructType([
    T.StructField("name", T.BinaryType()), T.StructField("parent", T.BinaryType()),
    T.StructField("root", T.BinaryType()), T.StructField("band", T.LongType()), T.StructField("depth", T.LongType()),
    T.StructField("chars", T.LongType()), T.StructField("conv_id", T.LongType()),
    T.StructField("parent_conv_id", T.LongType()), T.StructField("n_convs", T.LongType()),
    T.StructField("n_children", T.LongType()), T.StructField("n_leaves", T.LongType()),
    T.StructField("saved", T.LongType()), T.StructField("spine", T.BooleanType()),
    T.StructField("next", T.BinaryType()), T.StructField("above", T.ArrayType(T.BinaryType()))])


def _block(bands, has, hbs, paths, chars, counts, goes_on, least) -> pa.RecordBatch:
    """Nodes of one block of sorted distinct pieces (see ``NODE``)."""
    names: list[bytes] = []
    parent, depth, weight, root_of = [], [], [], []
    lcp, length = [], []
    stack: list[int] = []
    follow: dict[int, bytes] = {}  # of nodes that a lower band goes on from, the root there
    key, path = None, b""
    for i, p in enumerate(paths):
        k = (bands[i], has[i], hbs[i])
        n = len(p) // DIGEST
        if k != key:
            common = -1
            names.append(_root(*k))
            parent.append(-1)
            depth.append(0)
            weight.append(0)
            root_of.append(len(names) - 1)
            stack = [len(names) - 1]
        else:
            m = min(len(path) // DIGEST, n)
            differ = np.flatnonzero(np.frombuffer(path, "<u8")[:2 * m] != np.frombuffer(p, "<u8")[:2 * m])
            common = int(differ[0]) // 2 if len(differ) else m
        own = np.frombuffer(chars[i], ">i8")
        del stack[max(common, 0) + 1:]
        for d in range(max(common, 0), n):
            names.append(_child(names[stack[-1]], p[d * DIGEST:(d + 1) * DIGEST]))
            parent.append(stack[-1])
            depth.append(d + 1)
            weight.append(int(own[d]))
            root_of.append(stack[0])
            stack.append(len(names) - 1)
        if goes_on[i]:
            ta, tb = _terms(p, bands[i] * BAND)
            follow[stack[-1]] = _root(bands[i] + 1, _signed(has[i] + ta), _signed(hbs[i] + tb))
        if i == 0:
            first_spine = list(stack)
        lcp.append(common)
        length.append(n)
        key, path = k, p
    lcp, length = np.array(lcp), np.array(length)
    opened_by = length - lcp
    closed_by = np.concatenate([[0], length[:-1] - lcp[1:]])  # before path i opens its nodes
    ends = int(length[-1]) + 1
    shape = np.append(np.stack([closed_by, opened_by], axis=1).ravel(), ends)
    opens = np.repeat(np.append(np.tile([False, True], len(lcp)), False), shape)
    path_at = np.repeat(np.append(np.repeat(np.arange(len(lcp)), 2), len(lcp)), shape)
    place = np.flatnonzero(opens)
    close = Parentheses(opens).findclose(place)
    pre, size = np.arange(len(place)), (close - place + 1) // 2
    lo, hi = path_at[place], path_at[close]
    members = np.concatenate([[0], np.cumsum(counts)])
    n_convs = members[hi] - members[lo]
    conv = _range_min(np.asarray(least), lo, hi)
    spine = np.zeros(len(place), bool)
    spine[first_spine] = spine[stack] = True
    weight, parent, depth, root_of = (np.array(x, np.int64) for x in (weight, parent, depth, root_of))
    on = np.zeros(len(place), bool)
    on[list(follow)] = True
    # Leaf pairs, but for nodes that may go on elsewhere: their leaves are counted once they are merged.
    pair = np.append(opens[:-1] & ~opens[1:], False)
    pair[place[spine | on]] = False
    rank = np.concatenate([[0], np.cumsum(pair)])
    n_leaves = rank[close] - rank[place]
    gain = np.where(spine, 0, (n_convs - 1) * weight)
    saving = np.concatenate([[0], np.cumsum(gain)])
    saved = saving[pre + size] - saving[pre]
    counted = (parent >= 0) & ~spine
    n_children = np.bincount(parent[counted], minlength=len(place))
    inner = (parent >= 0) & ~spine[parent] & (depth[parent] > 0)
    band = np.array(bands, np.int64)[lo]
    lists: list[list[bytes] | None] = [None] * len(names)
    for x in np.flatnonzero(spine | on).tolist():
        line, y = [], x
        while y >= 0:
            line.append(names[y])
            y = int(parent[y])
        lists[x] = line
    return pa.record_batch(
        [pa.array(names, pa.binary()), pa.array([names[x] if x >= 0 else None for x in parent], pa.binary()),
         pa.array([names[x] for x in root_of], pa.binary()), pa.array(band), pa.array(band * BAND + depth),
         pa.array(weight), pa.array(conv), pa.array(conv[parent], mask=~inner), pa.array(n_convs),
         pa.array(n_children), pa.array(n_leaves), pa.array(saved), pa.array(spine),
         pa.array([follow.get(x) for x in range(len(names))], pa.binary()),
         pa.array(lists, pa.list_(pa.binary()))], names=NODE.names)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for a in range(0, b.num_rows, BLOCK):
            part = b.slice(a, BLOCK)
            bands, has, hbs, paths, chars, counts, goes_on, least = (c.to_pylist() for c in part.columns)
            yield _block(bands, has, hbs, paths, chars, np.array(counts, np.int64), goes_on,
                         np.array(least, np.int64))


# --- members that end at a node -----------------------------------------------------------

def _end_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for band, ha, hb, path in zip(*(b.column(c).to_pylist() for c in ("band", "ha", "hb", "path"))):
            name = _root(band, ha, hb)
            for d in range(0, len(path), DIGEST):
                name = _child(name, path[d:d + DIGEST])
            out.append(name)
        yield pa.record_batch([pa.array(out, pa.binary()), b.column("conv_id")], names=["name", "conv_id"])


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (name, conv_id) as rows of at most ``JOINED`` ids of one name."""
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    for b in batches:
        names, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
        out, a = [], 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[a] or i - a == JOINED:
                out.append((names[a], part, number, ",".join(map(str, ids[a:i]))))
                number, a = number + 1, i
        cols = list(zip(*out)) or [[]] * 4
        yield pa.record_batch([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()),
                               pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                              names=["name", "part", "number", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per name over its rows, which come in order."""
    name, sha = None, None

    def rows(done):
        return pa.record_batch([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])],
                               names=["name", "ends_sha256"])

    for b in batches:
        done = []
        for key, ids in zip(b.column("name").to_pylist(), b.column("ids").to_pylist()):
            if key != name:
                if sha is not None:
                    done.append((name, sha.hexdigest()))
                name, sha = key, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if done:
            yield rows(done)
    if sha is not None:
        yield rows([(name, sha.hexdigest())])


def _member_digests(pieces: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the nodes at which conversations end.

    Ids are sorted by range and joined by the thousand first; a SHA-256 has to
    be taken in one go, so a node's joined rows then pass through one task, which
    holds one of them at a time.
    """
    last = pieces.filter((F.col("band") + 1) * BAND >= F.col("n"))
    ends = last.select("band", "ha", "hb", "path", "conv_id").mapInArrow(_end_names, "name binary, conv_id long")
    order = ["name", "conv_id"]
    joined = (ends.repartitionByRange(*order).sortWithinPartitions(*order)
                  .mapInArrow(_join_ids, "name binary, part long, number long, ids string"))
    joined = materialize(joined, "ends")
    return (joined.repartition("name").sortWithinPartitions("name", "part", "number").select("name", "ids")
                  .mapInArrow(_digests, "name binary, ends_sha256 string"))


# --- the trie -------------------------------------------------------------------------

def _merged(nodes: DataFrame) -> DataFrame:
    """The nodes of spines, merged by name, complete within their band."""
    own = [F.first(c).alias(c) for c in ("parent", "root", "band", "depth", "chars", "above")]
    rows = (nodes.filter("spine").groupBy("name")
                 .agg(*own, F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
                      F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                      F.sum("saved").alias("saved"), F.first("next", ignorenulls=True).alias("next")))
    rows = materialize(rows, "spines")
    below = rows.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(
        F.count(F.lit(1)).alias("_kids"))
    rows = rows.join(below, "name", "left").withColumn("n_children", F.col("n_children") + F.coalesce("_kids", F.lit(0)))
    # What each spine node is itself, told to all spine nodes above it and to itself.
    leaf = ((F.col("n_children") == 0) & F.col("next").isNull()).cast("long")
    rows = materialize(rows.drop("_kids"), "spines")
    told = (rows.select(F.explode("above").alias("name"), leaf.alias("_leaf"),
                        ((F.col("n_convs") - 1) * F.col("chars")).alias("_saved"))
                .groupBy("name").agg(F.sum("_leaf").alias("_leaf"), F.sum("_saved").alias("_saved")))
    return rows.join(told, "name").withColumns({
        "n_leaves": F.col("n_leaves") + F.col("_leaf"), "saved": F.col("saved") + F.col("_saved")}).drop("_leaf", "_saved")


def _lower_totals(nodes: DataFrame) -> DataFrame:
    """(name, _leaves, _saved, _kids): what the bands below add to each node above them."""
    hooks = materialize(nodes.filter("next IS NOT NULL").select("name", "root", "band", "next", "above"), "hooks")
    roots = nodes.filter("parent IS NULL AND band > 0").select(
        F.col("name").alias("next"), "n_leaves", "saved", "n_children")
    roots = materialize(hooks.select("next", "root", "band").join(roots, "next"), "roots")
    # Sums over all roots below each root; after a round a root knows those twice as far.
    over = F.when(F.col("band") > 0, F.col("root"))
    state = materialize(roots.select(F.col("next").alias("at"), over.alias("up"), "n_leaves", "saved"), "totals")
    while state.filter("up IS NOT NULL").limit(1).count():
        add = materialize(state.filter("up IS NOT NULL").groupBy(F.col("up").alias("at")).agg(
            F.sum("n_leaves").alias("_l"), F.sum("saved").alias("_s")), "added")
        jump = state.select(F.col("at").alias("up"), F.col("up").alias("_up"))
        step = (state.join(add, "at", "left").join(jump, "up", "left")
                     .select("at", F.col("_up").alias("up"), (F.col("n_leaves") + F.coalesce("_l", F.lit(0))).alias("n_leaves"),
                             (F.col("saved") + F.coalesce("_s", F.lit(0))).alias("saved")))
        after = materialize(step, "totals")
        discard(state)
        state = after
    totals = hooks.join(state.select(F.col("at").alias("next"), "n_leaves", "saved"), "next").join(
        roots.select("next", "n_children"), "next")
    kids = F.when(F.col("_name") == F.col("name"), F.col("n_children")).otherwise(0)
    return (totals.select(F.explode("above").alias("_name"), "name", "n_leaves", "saved", "n_children")
                  .groupBy(F.col("_name")).agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved").alias("_saved"),
                                               F.sum(kids).alias("_kids"))
                  .withColumnRenamed("_name", "name"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, n, place, digest, chars), with the contract's columns.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256 of every distinct beginning.
    """
    pieces = _pieces(turns)
    goes_on = ((F.col("band") + 1) * BAND < F.col("n")).cast("int")
    key = ["band", "ha", "hb", "path"]
    distinct = pieces.groupBy(*key, "chars").agg(F.count(F.lit(1)).alias("n"), F.max(goes_on).alias("goes_on"),
                                                 F.min("conv_id").alias("least"))
    nodes = materialize(distinct.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_blocks, NODE), "nodes")
    columns = [c for c in NODE.names if c != "spine"]
    spines = _merged(nodes).withColumn("parent_conv_id", F.lit(None).cast("long"))
    whole = materialize(nodes.filter("NOT spine").select(columns).unionByName(spines.select(columns)), "whole")
    lower = _lower_totals(whole)
    full = whole.join(lower, "name", "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.coalesce("_leaves", F.lit(0)),
        "saved": F.col("saved") + F.coalesce("_saved", F.lit(0)),
        "n_children": F.col("n_children") + F.coalesce("_kids", F.lit(0))})
    full = full.filter("parent IS NOT NULL OR band = 0")
    # Parents that their block could not name: spines, and nodes under which a band begins.
    heads = spines.select("name", "conv_id").unionByName(
        whole.filter("next IS NOT NULL").select(F.col("next").alias("name"), "conv_id"))
    first = full.filter("parent IS NOT NULL AND parent_conv_id IS NULL").select("name", "parent")
    heads = materialize(whole.filter("parent IS NULL AND band = 0").select("name", "conv_id").unionByName(heads)
                             .groupBy("name").agg(F.min("conv_id").alias("_over")), "heads")
    named = first.join(heads.withColumnRenamed("name", "parent"), "parent").select("name", "_over")
    ends = _member_digests(pieces)
    return (full.join(named, "name", "left").join(ends, "name", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_over").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, span: int = 100, most: int = 6, **names) -> DataFrame:
    """Trie of all conversations, each rebuilt on the head of the first one of its span.

    Conversation c takes the first h turns of conversation c - c % ``span`` (h =
    crc32 of c, modulo ``most``) in place of its own first h.  Columns: see
    ``prefix_trie``; ``saved_tokens`` counts code points of texts that members
    share, (n_convs - 1) times, over a node's subtree.

    Defined cases: rows without a conversation id take no part; null role or text
    is empty; a null turn comes first; turns of one number are ordered by role,
    then by the SHA-256 of the text; repeated rows are turns like others; a
    conversation left without turns is a member of the root; a conversation of
    any length is rows of bounded size; an empty table gives no rows; further
    columns are ignored.  Equal means equal by 128-bit digests.
    """
    return prefix_trie(shared_heads(placed_turns(conversations, **names), span, most))
