"""Chains of matching distances between two maps: the open alignment rules of whole maps, blocks, seeds and molecules.

A chain pairs label i of one map with label j of the other and goes on to any pair up to ``REACH`` labels
further on both. A step matches if its two distances differ by no more than ``ALPHA`` of their sum; it
costs the squared deviation in units of ``ALPHA`` and ``SKIP`` for each label passed over. ``chain`` puts
matches first and cost second, under a limit on passed labels; ``cheapest`` puts cost first without one.

A row of cells is taken at once: the sixteen steps into each cell are sixteen shifted rows. Only the last
rows of scores are kept; a cell keeps the number of its step (one byte), and the scores along the chain
that is read back are added up again, so 50 labels against a chromosome's 100,000 need 5 MB.

Cases. A side with fewer than two labels gives no chain. Repeated places give steps of no length, which
deviate wholly. Ties go to the step from the earliest label of the first map, then of the second.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

# How far a step reaches, tolerated deviation, cost of a passed label, the score of a closed
# border, the cost step that joins stretches, and the sizes of blocks and seeds.
REACH = 4
ALPHA = 0.05
SKIP = 3.0
CLOSED = 9.0**9
JOIN = 16.0
BLOCK, WIDE, BACK = 50, 150, 100
SEED, MOLECULE_SEED = 50, 14
TURN_MARGIN = 20.0


@dataclass
class Chain:
    pairs: list[tuple[int, int]] = field(default_factory=list)
    cost: float = 0.0

    def better(self, other: Chain) -> bool:
        return len(self.pairs) > len(other.pairs) or (len(self.pairs) == len(other.pairs) and self.cost < other.cost)

    def moved(self, by_one: int = 0, by_two: int = 0) -> Chain:
        return Chain([(i + by_one, j + by_two) for i, j in self.pairs], self.cost)


_STEPS = [(a, b) for a in range(REACH, 0, -1) for b in range(REACH, 0, -1)]


def _table(one: np.ndarray, two: np.ndarray, top: np.ndarray, left: np.ndarray, limit: float, matches_first: bool):
    """Steps into all cells, and matches and costs of the last row and of the last column."""
    m, n = len(one), len(two)
    steps = np.full((m, n), -1, np.int8)
    seen = [(np.zeros(n, np.int64), top.copy(), np.zeros(n, np.int64))]
    edge = [(0, float(top[-1]))]
    for i in range(1, m):
        count = np.full((len(_STEPS), n), -1, np.int64)
        cost = np.full((len(_STEPS), n), np.inf)
        passed = np.zeros((len(_STEPS), n), np.int64)
        for s, (a, b) in enumerate(_STEPS):
            if a > i or b >= n:
                continue
            was_count, was_cost, was_passed = seen[-a]
            q, r = one[i] - one[i - a], two[b:] - two[:-b]
            whole = np.abs(q + r)
            dev = np.where(whole > 0, np.abs(q - r) / np.where(whole > 0, whole, 1.0), 1.0)
            over = was_passed[:-b] + (a + b - 2)
            good = over <= limit
            count[s, b:] = np.where(good, was_count[:-b] + (dev <= ALPHA), -1)
            cost[s, b:] = np.where(good, was_cost[:-b] + (dev / ALPHA) ** 2 + SKIP * (a + b - 2), np.inf)
            passed[s, b:] = over
        rank = np.where(count == count.max(0), cost, np.inf) if matches_first else cost
        pick = rank.argmin(0)
        at = np.arange(n)
        c, k, p = cost[pick, at], count[pick, at], passed[pick, at]
        found = np.isfinite(c) & ((c < CLOSED) | ((k > 0) & matches_first))
        k, c, p = np.where(found, k, 0), np.where(found, c, CLOSED), np.where(found, p, 0)
        k[0], c[0], p[0], found[0] = 0, left[i], 0, False
        steps[i] = np.where(found, pick, -1)
        seen = [*seen[-REACH + 1 :], (k, c, p)]
        edge.append((int(k[-1]), float(c[-1])))
    return steps, seen[-1][0], seen[-1][1], edge


def _read_back(one, two, steps, i: int, j: int) -> tuple[list[tuple[int, int]], list[bool], list[float]]:
    """The cells of a path from its start, whether the step into each matched, and the cost up to each."""
    path = [(i, j)]
    while steps[i, j] >= 0:
        a, b = _STEPS[steps[i, j]]
        i, j = i - a, j - b
        path.append((i, j))
    path.reverse()
    matched, costs = [False], [0.0]
    for (k, l), (i, j) in zip(path, path[1:]):
        q, r = one[i] - one[k], two[j] - two[l]
        dev = abs(q - r) / abs(q + r) if q + r else 1.0
        matched.append(bool(dev <= ALPHA))
        costs.append(costs[-1] + (dev / ALPHA) ** 2 + SKIP * (i - k - 1 + j - l - 1))
    return path, matched, costs


def _stretches(matched: list[bool]) -> list[tuple[int, int]]:
    """First and last cell of every run of matched steps."""
    out: list[tuple[int, int]] = []
    for t, m in enumerate(matched):
        if m:
            out[-1:] = [(out[-1][0], t)] if out and out[-1][1] == t - 1 and matched[t - 1] else [*out[-1:], (t - 1, t)]
    return out


def chain(one: np.ndarray, two: np.ndarray, both: int | None = None) -> Chain:
    """The best chain (matches, then cost), of which the longest stretch of matched steps is kept and joined
    by its neighbours while the cost between them is no more than ``JOIN``.

    ``both``: None, or bits that open the upper (1) and the left (2) border. With it, chains of fewer than five
    pairs or that miss over a third of their pairs at open ends are no chains; without it, those that miss twice
    their pairs."""
    m, n = len(one) - 1, len(two) - 1
    if m < 1 or n < 1:
        return Chain()
    limit = max(math.ceil(min(m, n) * ALPHA), 2 if both is None else 3)
    border = lambda size, free, opened: np.where((np.arange(size + 1) <= max(free, 0)) | opened, 0.0, CLOSED)
    top, left = border(n, n - m, bool(both and both & 1)), border(m, m - n, both is None or bool(both & 2))
    steps, last_count, last_cost, edge = _table(one, two, top, left, limit, True)
    ends = [(int(last_count[j]), -float(last_cost[j]), (m, j)) for j in range(n, -1, -1)]
    if m > n or (both or 0) & 1:
        ends += [(edge[i][0], -edge[i][1], (i, n)) for i in range(m - 1, -1, -1)]
    best = max(ends, key=lambda e: e[:2])
    if best[0] <= 0:
        return Chain()
    path, matched, costs = _read_back(one, two, steps, *best[2])
    runs = _stretches(matched)
    at = min(range(len(runs)), key=lambda k: (runs[k][0] - runs[k][1], costs[runs[k][1]] - costs[runs[k][0]]))
    lo, hi = runs[at]
    for first, last in reversed(runs[:at]):
        if costs[lo] - costs[last] > JOIN:
            break
        lo = first
    for first, last in runs[at + 1 :]:
        if costs[first] - costs[hi] > JOIN:
            break
        hi = last
    pairs = path[lo : hi + 1]
    return Chain(pairs, costs[hi] - costs[lo]) if _complete(pairs, m, n, both) else Chain()


def _complete(pairs: list[tuple[int, int]], m: int, n: int, both: int | None) -> bool:
    (i, j), (k, l) = pairs[0], pairs[-1]
    if both is None:
        return (m - k) + j < 2 * len(pairs)
    before, after = i, m - k
    if both & 1 and l == n and not (both & 2 and j == 0):
        missed = before
    elif both & 2 and j == 0:
        missed = after
    else:
        missed = before + after
    return len(pairs) >= 5 and missed <= 0.333 * len(pairs)


def cheapest(one: np.ndarray, two: np.ndarray) -> Chain:
    """The chain of least cost into the last label of ``one``, all of its matched steps."""
    m, n = len(one) - 1, len(two) - 1
    if m < 1 or n < 1:
        return Chain()
    steps, count, cost, _ = _table(one, two, np.zeros(n + 1), np.zeros(m + 1), math.inf, False)
    j = max(range(1, n + 1), key=lambda j: (count[j], -cost[j]))
    path, matched, costs = _read_back(one, two, steps, m, j)
    kept = sorted({t for first, last in _stretches(matched) for t in range(first, last + 1)})
    return Chain([path[t] for t in kept], costs[-1])


def in_blocks(one: np.ndarray, two: np.ndarray, least: float = 0.9) -> Chain:
    """The shorter map in blocks of ``BLOCK`` labels, each against up to ``WIDE`` labels from where the last one
    ended; a chain if at least ``least`` of all labels are paired, given up as soon as that is out of reach."""
    if len(one) <= 3 or len(two) <= 3:
        return Chain()
    turned = len(one) > len(two)
    a, b = (two, one) if turned else (one, two)
    pairs: list[tuple[int, int]] = []
    at, to, tried, reach, cost = 0, 0, 0, WIDE, 0.0
    while at < len(a) and to < len(b):
        size = min(BLOCK, len(a) - at)
        c = cheapest(a[at : at + size], b[to : to + reach])
        tried += size
        if len(c.pairs) >= least * size:
            pairs += c.moved(at, to).pairs
            cost += c.cost
            # The rest of a block is tried again with the next one, as its labels were counted.
            at, to, reach = at + c.pairs[-1][0] + 1, to + c.pairs[-1][1] + 1, WIDE
        else:
            at += size
            to = max(to, at - BACK)
            reach = max(at - to, 0) + WIDE
        left = max(len(a) - tried, 0)
        if len(pairs) + left < least * (tried + left):
            return Chain()
        if tried >= len(a):
            break
    return Chain([(j, i) for i, j in pairs] if turned else pairs, cost) if len(pairs) >= least * tried else Chain()


def overlap_ends(one: np.ndarray, two: np.ndarray, seed: int = SEED) -> Chain:
    """How the end of ``one`` goes on in the beginning of ``two``: the last labels of one against all of two, all of
    one against the first labels of two, the better of both."""
    if len(one) <= 1 or len(two) <= 1:
        return Chain()
    if len(one) <= seed and len(two) <= seed:
        return chain(one, two)
    first = chain(one[-seed:], two).moved(by_one=max(len(one) - seed, 0))
    second = chain(one, two[:seed])
    return first if first.better(second) else second


def turned(p: np.ndarray) -> np.ndarray:
    """A map turned round, in whole bp, the last label ``TURN_MARGIN`` from the new start."""
    return np.trunc(p[-1] + TURN_MARGIN - p[::-1]) if len(p) else p


def either_way(one: np.ndarray, two: np.ndarray, align) -> tuple[Chain, bool]:
    """The better of both directions of ``one``, its labels numbered as given, and whether it was turned."""
    straight, back = align(one, two), align(turned(one), two)
    if straight.better(back):
        return straight, False
    return Chain([(len(one) - 1 - i, j) for i, j in back.pairs], back.cost), bool(back.pairs)


def _both_seeds(one: np.ndarray, two: np.ndarray) -> Chain:
    """The first and the last labels of ``one`` as seeds, each open towards its own side; what the second adds
    behind the first."""
    head, tail = chain(one[:MOLECULE_SEED], two, 1), chain(one[-MOLECULE_SEED:], two, 2).moved(by_one=len(one) - MOLECULE_SEED)
    if not head.pairs:
        return tail
    return Chain(head.pairs + [p for p in tail.pairs if p > head.pairs[-1]], head.cost + tail.cost if tail.pairs else head.cost)


def molecule(contig: np.ndarray, molecule_labels: np.ndarray) -> Chain:
    """A contig's end on a molecule (pairs of contig label and molecule label), in either direction."""
    if len(contig) <= 1 or len(molecule_labels) <= 1:
        return Chain()
    whole = len(contig) <= 1.5 * MOLECULE_SEED
    return either_way(contig, molecule_labels, (lambda a, b: chain(a, b, 3)) if whole else _both_seeds)[0]


def linkage(pairs: list[tuple[int, int]], contig: np.ndarray, contig_length: float, mol: np.ndarray, mol_length: float) -> tuple[str, str, float, float, float, str]:
    """end (5 or 3), dir, start, mid, end and side of the part of a molecule that an aligned contig leaves free: the
    contig's far end is carried on along the molecule, the rest lies before (-) or behind (+) it."""
    (i, j), (k, l) = pairs[0], pairs[-1]
    end = "5" if i + k < len(contig) else "3"
    way = "+" if i <= k else "-"
    if (way == "+") != (end == "3"):
        out = contig[i] if way == "+" else contig_length - contig[i]
        return end, way, 0.0, max(float(mol[j] - out), 0.0), float(mol[l]), "-"
    out = contig_length - contig[k] if way == "+" else contig[k]
    return end, way, float(mol[j]), min(float(mol[l] + out), float(mol_length)), float(mol_length), "+"
