"""The packing plan of operator 1, on counts of lengths alone.

Lengths are integers up to the capacity, so a corpus of any size is described by at most ``capacity`` counts, and the plan
by runs of equal lengths in runs of equal sequences. The steps are those of the linear grouping scheme:

1. large lengths are sorted and cut into groups of equal cardinality, each rounded up to its largest member;
2. the few rounded sizes are packed by configurations: a linear programme over multisets of sizes that fit, solved by
   column generation with a knapsack as pricing step, and rounded down;
3. actual lengths, each at most its group's size, take the places of the rounded ones;
4. what is left, and all small lengths, go by best fit (longest first, tightest sequence) into the gaps.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from dataclasses import dataclass

import numpy as np

GROUPS, LARGE_PARTS = 40, 10


@dataclass(frozen=True)
class Run:
    """``copies`` sequences from ``sequence`` on, each with ``each`` items of ``length`` at ``offset``; ranks count the items of that length."""

    length: int
    rank: int
    copies: int
    each: int
    sequence: int
    offset: int


def equal_groups(counts: dict[int, int], groups: int) -> list[list[list[int]]]:
    """Lengths in falling order cut into at most ``groups`` lists of [length, count] of (nearly) equal cardinality."""
    total, out, filled = sum(counts.values()), [], 0
    share = max(1, -(-total // groups))
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            if not out or filled == share:
                out.append([])
                filled = 0
            take = min(n, share - filled)
            out[-1].append([length, take])
            filled += take
            n -= take
    return out


def best_configuration(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes that fits and is worth most."""
    best = np.zeros(capacity + 1)
    chosen = []
    for size, value in zip(sizes, values, strict=True):
        pick = np.zeros(capacity + 1, np.int16)
        if value > 1e-12:
            base = best
            best = base.copy()
            for c in range(1, capacity // size + 1):
                offer = base[: capacity + 1 - c * size] + c * value
                here = best[c * size :]
                better = offer > here + 1e-12
                here[better] = offer[better]
                pick[c * size :][better] = c
        chosen.append(pick)
    column, room = np.zeros(len(sizes)), capacity
    for i in range(len(sizes) - 1, -1, -1):
        column[i] = chosen[i][room]
        room -= int(column[i]) * sizes[i]
    return float(best[capacity]), column


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 3000) -> list[tuple[np.ndarray, float]]:
    """(configuration, copies) of an optimal fractional packing of the rounded sizes."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    amounts = np.linalg.solve(basis, need)
    for _ in range(rounds):
        worth = np.linalg.solve(basis.T, np.ones(k))
        value, column = best_configuration(sizes, worth, capacity)
        if value <= 1 + 1e-9:
            break
        way = np.linalg.solve(basis, column)
        able = way > 1e-9
        ratios = np.where(able, np.maximum(amounts, 0) / np.where(able, way, 1), np.inf)
        out = int(np.argmin(ratios))
        basis[:, out] = column
        amounts = np.linalg.solve(basis, need)
    return [(basis[:, j].copy(), float(amounts[j])) for j in range(k) if amounts[j] > 1e-9]


def plan(counts: dict[int, int], capacity: int, groups: int = GROUPS, large_parts: int = LARGE_PARTS) -> tuple[list[Run], int]:
    """Runs that place every item of ``counts`` (length -> items), and the number of sequences."""
    counts = {length: n for length, n in counts.items() if n}
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("lengths must lie between 1 and the capacity")
    bins: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = defaultdict(list)  # room left -> (items, sequences)
    rooms: list[int] = []

    def put(items: tuple[tuple[int, int], ...], n: int) -> None:
        if not n:
            return
        room = capacity - sum(length * each for length, each in items)
        if not bins[room]:
            bisect.insort(rooms, room)
        bins[room].append((items, n))

    large = {length: n for length, n in counts.items() if capacity // large_parts < length < capacity}
    rest = {length: n for length, n in counts.items() if length <= capacity // large_parts}
    put(((capacity, 1),), counts.get(capacity, 0))
    streams = equal_groups(large, groups)
    if streams:
        sizes, demand = [g[0][0] for g in streams], [sum(n for _, n in g) for g in streams]
        merged: dict[int, int] = {}
        for i, s in enumerate(sizes):  # groups cut from one length have one size: one row of the programme
            merged.setdefault(s, i)
        if len(merged) < len(sizes):
            joined: dict[int, list[list[int]]] = defaultdict(list)
            for s, g in zip(sizes, streams, strict=True):
                joined[s] += g
            streams, sizes = list(joined.values()), list(joined)
            demand = [sum(n for _, n in g) for g in streams]
        for column, amount in configurations(sizes, demand, capacity):
            copies = int(amount + 1e-6)
            wanted = [(g, int(round(c))) for g, c in enumerate(column) if c > 0.5]
            left = [sum(n for _, n in streams[g]) for g, _ in wanted]
            copies = min([copies, *(n // c for n, (_, c) in zip(left, wanted, strict=True))]) if wanted else 0
            while copies:
                even = min([copies, *(streams[g][0][1] // c for g, c in wanted)])
                items: list[tuple[int, int]] = []
                for g, c in wanted:  # whole copies of the next lengths, or one copy of mixed lengths
                    need = c * max(even, 1)
                    while need:
                        head = streams[g][0]
                        take = min(head[1], need)
                        items.append((head[0], take // max(even, 1)))
                        head[1] -= take
                        need -= take
                        if not head[1]:
                            streams[g].pop(0)
                put(tuple(items), max(even, 1))
                copies -= max(even, 1)
        for g in streams:
            for length, n in g:
                rest[length] = rest.get(length, 0) + n
    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                put(((length, each),), n // each)
                put(((length, n % each),) if n % each else (), bool(n % each))
                break
            room = rooms[at]
            items, copies = bins[room].pop()
            if not bins[room]:
                del rooms[at]
            each = room // length
            full = min(copies, n // each)
            put((*items, (length, each)), full)
            n -= full * each
            copies -= full
            if copies and n and n < each:
                put((*items, (length, n)), 1)
                copies, n = copies - 1, 0
            put(items, copies)
    runs, ranks, sequence = [], defaultdict(int), 0
    for room in list(rooms):
        for items, copies in bins[room]:
            offset = 0
            for length, each in items:
                runs.append(Run(length, ranks[length], copies, each, sequence, offset))
                ranks[length] += copies * each
                offset += length * each
            sequence += copies
    if dict(ranks) != counts:
        raise AssertionError("the plan does not hold every item once")
    return runs, sequence
