"""Suffix arrays by grouping: linear time, without recursion and without renaming symbols.

Suffixes start in one group for each first symbol. Groups are taken from the highest to the lowest. Each member
of the group at hand looks for the nearest position before it whose suffix is in a lower group (the pointers of
higher ones are followed, so every position is looked at once). The positions found leave their groups for new
ones right above, those found by more members higher: their prefix grows by the Lyndon words that follow it. In
the end a group holds the suffixes that start with one Lyndon prefix, and the pointers lead to the next smaller
suffix before. The second phase reads suffixes in order, and hands out the places of each group along the pointers.
"""

from __future__ import annotations

from collections.abc import Sequence


def lyndon_groups(text: Sequence[int]) -> tuple[list[list[int]], list[int]]:
    """Groups of suffixes with equal Lyndon prefixes in falling order, and for each position the nearest one
    before it whose suffix is smaller (-1 without)."""
    n = len(text)
    held: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        held.setdefault(symbol, []).append(i)
    members = [held[symbol] for symbol in sorted(held)]
    group = [0] * n
    for g, positions in enumerate(members):
        for i in positions:
            group[i] = g
    size = [len(m) for m in members]
    lower, upper = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    upper[-1:] = [-1]
    done, before = bytearray(n), [-1] * n
    order = []

    def move(positions: list[int], old: int) -> None:
        """Put some members of ``old`` into a group right above it; all of them are that group already."""
        if len(positions) == size[old]:
            return
        new, above = len(members), upper[old]
        members.append(positions)
        size.append(len(positions))
        size[old] -= len(positions)
        for i in positions:
            group[i] = new
        lower.append(old)
        upper.append(above)
        upper[old] = new
        lower[above] = new

    g = len(members) - 1
    while g >= 0:
        live = members[g]
        if len(live) != size[g]:
            live = [i for i in live if group[i] == g]
        order.append(live)
        for i in live:
            done[i] = 1
        found, times = [], []
        for i in live:
            j = i - 1
            while j >= 0 and done[j]:
                j = before[j]
            before[i] = j
            if j >= 0:
                if found and found[-1] == j:
                    times[-1] += 1
                else:
                    found.append(j)
                    times.append(1)
        if len(found) == 1:
            move(found, group[found[0]])
        elif found:
            by_times: dict[int, list[int]] = {}
            for j, t in zip(found, times):
                by_times.setdefault(t, []).append(j)
            for t in sorted(by_times, reverse=True):
                by_group: dict[int, list[int]] = {}
                for j in by_times[t]:
                    by_group.setdefault(group[j], []).append(j)
                for old, positions in by_group.items():
                    move(positions, old)
        g = lower[g]
    return order, before


def suffix_array(text: Sequence[int]) -> list[int]:
    """The positions of ``text`` in the order of their suffixes; a suffix sorts before its extensions."""
    n = len(text)
    order, before = lyndon_groups(text)
    place = [0] * n
    free, first = [], 0
    for g, positions in enumerate(reversed(order)):
        for i in positions:
            place[i] = g
        free.append(first)
        first += len(positions)
    out, placed = [-1] * n, bytearray(n)

    def emit(j: int) -> None:
        while j >= 0 and not placed[j]:
            g = place[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = before[j]

    emit(n - 1)
    for rank in range(n):
        emit(out[rank] - 1)
    return out
