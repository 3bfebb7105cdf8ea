"""The open alignment rules against a cell-by-cell statement of them, and worked cases."""

import math

import numpy as np
import pytest

from cartolux.functions import chains as C


def plain(one, two, top, left, limit, matches_first):
    """Scores of all cells, one at a time."""
    m, n = len(one), len(two)
    s = {(0, j): (0, top[j], 0) for j in range(n)} | {(i, 0): (0, left[i], 0) for i in range(m)}
    s[0, 0] = (0, top[0], 0)
    for i in range(1, m):
        for j in range(1, n):
            best = (0, C.CLOSED, 0)
            for k in range(max(i - 4, 0), i):
                for l in range(max(j - 4, 0), j):
                    skip = (i - k - 1) + (j - l - 1)
                    if s[k, l][2] + skip > limit:
                        continue
                    q, r = one[i] - one[k], two[j] - two[l]
                    dev = abs(q - r) / (q + r)
                    new = (s[k, l][0] + (dev <= 0.05), s[k, l][1] + (dev / 0.05) ** 2 + 3 * skip, s[k, l][2] + skip)
                    if (new[0], -new[1]) > (best[0], -best[1]) if matches_first else new[1] < best[1]:
                        best = new
            s[i, j] = best
    return s


@pytest.mark.parametrize("matches_first", [True, False])
def test_scores_are_those_of_every_cell(matches_first):
    rng = np.random.default_rng(4)
    for _ in range(12):
        one = np.cumsum(rng.integers(500, 9000, rng.integers(3, 14))).astype(float)
        two = np.cumsum(rng.integers(500, 9000, rng.integers(3, 14))).astype(float)
        top, left = rng.choice([0.0, C.CLOSED], len(two)), rng.choice([0.0, C.CLOSED], len(one))
        top[0] = 0.0
        limit = 3 if matches_first else math.inf
        _, count, cost, edge = C._table(one, two, top, left, limit, matches_first)
        s = plain(one, two, top, left, limit, matches_first)
        last = len(one) - 1
        assert [int(c) for c in count[1:]] == [s[last, j][0] for j in range(1, len(two))]
        assert np.allclose(cost[1:], [s[last, j][1] for j in range(1, len(two))])
        assert [e[0] for e in edge[1:]] == [s[i, len(two) - 1][0] for i in range(1, len(one))]


def maps(seed, n=60):
    rng = np.random.default_rng(seed)
    return np.cumsum(rng.integers(2000, 20000, n)).astype(float)


def test_same_map_and_part_of_it():
    p = maps(1)
    assert C.chain(p, p).pairs == [(i, i) for i in range(60)] and C.chain(p, p).cost == 0
    assert C.chain(p[20:40], p).pairs == [(i, i + 20) for i in range(20)]
    assert C.cheapest(p[10:30], p).pairs == [(i, i + 10) for i in range(20)]
    assert C.overlap_ends(p[:45], p[30:]).pairs == [(30 + i, i) for i in range(15)]


def test_missing_label_is_passed_over_and_others_reject():
    p = maps(2)
    less = np.delete(p, 25)
    assert C.chain(less, p).pairs == [(i, i + (i >= 25)) for i in range(59)]
    assert C.chain(maps(3, 30), p).pairs == [] or len(C.chain(maps(3, 30), p).pairs) < 12
    assert C.chain(p[:4], p, 3).pairs == []  # fewer than five pairs
    assert C.chain(p[:1], p).pairs == C.cheapest(p, p[:1]).pairs == C.in_blocks(p[:3], p).pairs == []


def test_blocks():
    p = maps(5, 400)
    assert C.in_blocks(p[100:320], p[95:]).pairs == [(i, i + 5) for i in range(220)]
    assert C.in_blocks(p[95:], p[100:320]).pairs == [(i + 5, i) for i in range(220)]
    assert C.in_blocks(maps(6, 120), p).pairs == []


def test_molecule_end_direction_and_linkage():
    p = maps(7, 40)
    mol = p[25:] - p[25] + 3000.0  # holds the contig's 3' end and goes on behind it
    mol = np.concatenate([mol, mol[-1] + np.array([7000.0, 15000.0, 21000.0])])
    c = C.molecule(p, mol)
    assert c.pairs[-1] == (39, 14) and all(i - j == 25 for i, j in c.pairs)
    assert C.linkage(c.pairs, p, p[-1] + 500, mol, mol[-1] + 100) == ("3", "+", mol[c.pairs[0][1]], mol[14] + 500, mol[-1] + 100, "+")
    back = C.molecule(C.turned(p), mol)
    assert {(39 - i, j) for i, j in back.pairs} == set(c.pairs)
    end, way, *_ = C.linkage(back.pairs, C.turned(p), p[-1] + 20, mol, mol[-1] + 100)
    assert (end, way) == ("5", "-")
