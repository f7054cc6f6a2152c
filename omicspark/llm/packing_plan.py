"""Which pieces share a window: non-negative least squares on the histogram of lengths.

All of this sees a histogram of at most ``window`` counts, never the pieces.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import defaultdict, deque
from dataclasses import dataclass

import numpy as np

ROUNDS = 100


def combinations_filling(window: int, lengths: np.ndarray) -> np.ndarray:
    """Rows of three ascending lengths that fill the window; a zero first for two. Only lengths that occur."""
    have = np.zeros(window + 1, dtype=bool)
    have[lengths] = True
    have[0] = True
    found = []
    for a in np.flatnonzero(have[: window // 3 + 1]).tolist():
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        c = window - a - b
        ok = have[b] & have[c] & (c >= b)
        found.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)


def solve_counts(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that bring the lengths used near the histogram in least squares.

    Coordinate descent: each round takes the exact step of every combination that
    improves the most among all that share a length with it. Those have no length
    in common, so their steps don't disturb each other.
    """
    weight = np.ones(len(histogram))
    weight[0] = 0
    left = histogram.astype(np.float64).copy()
    left[0] = 0
    x = np.zeros(len(combos))
    if not len(combos):
        return x
    a, b, c = combos.T
    same = (a == b).astype(float) + (b == c) + (a == c)
    norm = weight[a] + weight[b] + weight[c] + 2 * same  # a length used m times counts m * m
    tie = np.arange(len(combos)) * 1e-9
    for _ in range(ROUNDS):
        step = np.maximum((left[a] + left[b] + left[c]) / norm, -x)
        gain = np.abs(step) * np.sqrt(norm)
        if gain.max() < 1:
            break
        gain += tie
        best = np.zeros(len(histogram))
        for part in (a, b, c):
            np.maximum.at(best, part, gain)
        pick = np.flatnonzero((gain >= best[b]) & (gain >= best[c]) & ((a == 0) | (gain >= best[a])))
        x[pick] += step[pick]
        for part in (a, b, c):
            np.subtract.at(left, part[pick], step[pick])
        left[0] = 0
    return x


@dataclass
class Plan:
    """Where the piece of a length and rank goes. Its parts are those of the interval of ranks that holds it."""

    keys: np.ndarray  # length << RANK_BITS | first rank, ascending
    first: np.ndarray  # of each interval, its first part
    start: np.ndarray  # of each part, its start in the piece
    size: np.ndarray
    shift: np.ndarray  # sequence - rank
    offset: np.ndarray  # in the sequence
    sequences: int

    RANK_BITS = 48

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part) of every part of pieces given by length and rank."""
        at = np.searchsorted(self.keys, (lengths.astype(np.int64) << self.RANK_BITS) | ranks, side="right") - 1
        n = self.first[at + 1] - self.first[at]
        row = np.repeat(np.arange(len(at)), n)
        return row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.first[at][row]


class _Stock:
    """Pieces left, by length: runs of ranks of an original length, from some start within the piece."""

    def __init__(self, histogram: np.ndarray):
        self.runs: dict[int, deque] = defaultdict(deque)
        self.count = histogram.astype(np.int64).copy()
        self.lengths = np.flatnonzero(self.count).tolist()
        for n in self.lengths:
            self.runs[n].append((n, 0, int(self.count[n]), 0))
        self.rows: list[tuple] = []
        self.sequences = 0

    def add(self, length: int, run: tuple) -> None:
        if not self.count[length]:
            insort(self.lengths, length)
        self.count[length] += run[2] - run[1]
        self.runs[length].append(run)

    def use(self, length: int, n: int, offset: int, size: int) -> None:
        """Put the first ``size`` ids of n pieces at ``offset`` of the next n sequences; what is left of each goes back."""
        at, back = self.sequences, []
        self.count[length] -= n
        while n:
            origin, lo, hi, start = self.runs[length].popleft()
            m = min(n, hi - lo)
            if m < hi - lo:
                self.runs[length].appendleft((origin, lo + m, hi, start))
            self.rows.append((origin, lo, lo + m, start, size, at - lo, offset))
            if size < length:
                back.append((origin, lo, lo + m, start + size))
            at, n = at + m, n - m
        if not self.count[length]:
            self.lengths.remove(length)
        for run in back:
            self.add(length - size, run)

    def fill(self, slots: list[tuple[int, int]], n: int) -> None:
        """n sequences of these (length, ids used) slots."""
        offset = 0
        for length, size in slots:
            self.use(length, n, offset, size)
            offset += size
        self.sequences += n

    def greedy(self, window: int) -> list[tuple[int, int]]:
        """The longest piece, then the longest that fits, again and again; the last gap gets the head of a cut piece."""
        used: dict[int, int] = defaultdict(int)
        slots, gap, upto = [], window, len(self.lengths)
        while gap:
            upto = bisect_right(self.lengths, gap, 0, upto)
            while upto and used[self.lengths[upto - 1]] >= self.count[self.lengths[upto - 1]]:
                upto -= 1
            if not upto:
                break
            n = self.lengths[upto - 1]
            used[n] += 1
            slots.append((n, n))
            gap -= n
        if gap:
            at = bisect_right(self.lengths, gap)
            while at < len(self.lengths) and used[self.lengths[at]] >= self.count[self.lengths[at]]:
                at += 1
            if at < len(self.lengths):
                slots.append((self.lengths[at], gap))
        return slots

    def repeats(self, slots: list[tuple[int, int]]) -> int:
        need: dict[int, int] = defaultdict(int)
        for n, _ in slots:
            need[n] += 1
        return int(min(self.count[n] // m for n, m in need.items()))


def plan_packing(histogram: np.ndarray, window: int) -> Plan:
    """histogram[n] pieces of n ids, n from 0 (none) to window."""
    stock = _Stock(histogram)
    if stock.count[window]:
        stock.fill([(window, window)], int(stock.count[window]))
    combos = combinations_filling(window, np.array(stock.lengths, dtype=np.int64))
    counts = np.floor(solve_counts(combos, stock.count) + 1e-6).astype(np.int64)
    for at in np.argsort(-counts, kind="stable")[: int((counts > 0).sum())].tolist():
        slots = [(n, n) for n in combos[at].tolist() if n]
        if all(stock.count[n] for n, _ in slots) and (n := min(int(counts[at]), stock.repeats(slots))):
            stock.fill(slots, n)
    while stock.lengths:
        slots = stock.greedy(window)
        total = sum(size for _, size in slots)
        if total == window:
            stock.fill(slots, stock.repeats(slots))
            continue
        # All that is left, less than a window: sequences of powers of two need no padding.
        room = 1 << (total.bit_length() - 1)
        slots = []
        for n in stock.lengths[::-1]:
            for _ in range(int(stock.count[n])):
                size = min(n, room)
                if size:
                    slots.append((n, size))
                    room -= size
        stock.fill(slots, 1)
    return _plan(stock, window)


def _plan(stock: _Stock, window: int) -> Plan:
    by_length: dict[int, list[tuple]] = defaultdict(list)
    for row in stock.rows:
        by_length[row[0]].append(row)
    keys, first, parts = [], [0], []
    for length in sorted(by_length):
        rows = sorted(by_length[length], key=lambda r: r[3])
        cuts = sorted({r[1] for r in rows} | {r[2] for r in rows})
        inside: list[list[tuple]] = [[] for _ in cuts]
        where = {c: i for i, c in enumerate(cuts)}
        for r in rows:
            for i in range(where[r[1]], where[r[2]]):
                inside[i].append(r)
        for c, own in zip(cuts[:-1], inside):
            keys.append((length << Plan.RANK_BITS) | c)
            parts += [r[3:] for r in own]
            first.append(len(parts))
    start, size, shift, offset = np.array(parts, dtype=np.int64).reshape(-1, 4).T
    return Plan(np.array(keys, dtype=np.int64), np.array(first, dtype=np.int64), start, size, shift, offset, stock.sequences)
