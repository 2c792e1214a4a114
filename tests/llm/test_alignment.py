"""Patience alignment by its definition: longest runs found by trying all, order kept, blocks maximal."""
import random

from marquee.llm import linediff


def longest(pairs):
    """Length of the longest run rising in both members, by dynamic programming."""
    best = []
    for i, (x, y) in enumerate(pairs):
        best.append(1 + max((best[j] for j in range(i) if pairs[j][0] < x and pairs[j][1] < y), default=0))
    return max(best, default=0)


def shared_lines(rng, n):
    ys = rng.sample(range(2 * n + 2), n)
    xs = sorted(rng.sample(range(2 * n + 2), n))
    return [(x, y, rng.random() < rng.choice([0.2, 0.7, 1.0])) for x, y in zip(xs, ys)]


def test_alignment_is_of_greatest_length_in_every_gap():
    rng = random.Random(12)
    for _ in range(3000):
        shared = shared_lines(rng, rng.randrange(0, 14))
        got = linediff.align(shared)
        assert set(got) <= {(x, y) for x, y, _ in shared}
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))
        once = {(x, y) for x, y, o in shared if o}
        anchors = [p for p in got if p in once]
        assert len(anchors) == longest(sorted(once))
        edges = [(-1, -1), *anchors, (1 << 62, 1 << 62)]
        for (x0, y0), (x1, y1) in zip(edges, edges[1:]):
            gap = [(x, y) for x, y, o in shared if not o and x0 < x < x1 and y0 < y < y1]
            mine = [p for p in got if p not in once and x0 < p[0] < x1]
            assert set(mine) <= set(gap) and len(mine) == longest(gap)


def test_blocks_are_maximal_stretches_on_both_sides():
    """Neighbours of a block are one line apart on both sides, or two (a line stands between); blocks cannot be joined."""
    rng = random.Random(13)
    for _ in range(2000):
        got = linediff.align(shared_lines(rng, rng.randrange(0, 20)))
        blocks, at = linediff.blocks(got), dict(got)
        assert [x for b in blocks for x in b] == [x for x, _ in got]

        def joined(x, y):
            return y - x == at[y] - at[x] <= 2

        assert all(joined(x, y) for b in blocks for x, y in zip(b, b[1:]))
        assert not any(joined(b[-1], c[0]) for b, c in zip(blocks, blocks[1:]))
