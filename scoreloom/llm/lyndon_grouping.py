"""Suffix array by grouping suffixes on their Lyndon prefixes.

Phase one keeps the suffixes in ordered groups, at first by their symbol. Groups are processed from
the highest down. Every suffix of a group points to the nearest suffix before it that lies in a
lower group; how many point to the same one tells how often the group's prefix follows there, so
those suffixes leave their group for new ones right above it, more repeats higher up. In the end a
group holds the suffixes with one Lyndon prefix. Phase two writes the order from the smallest suffix
on, following the same pointers; no shorter text is made and sorted in between.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in lexicographic order; a suffix sorts before what extends it."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    symbols, first = np.unique(text, return_inverse=True)
    by_symbol = np.argsort(first, kind="stable")
    ends = np.cumsum(np.bincount(first))
    members = [part.tolist() for part in np.split(by_symbol, ends[:-1])]
    group_of: list[int] = first.tolist()
    below = list(range(-1, len(symbols) - 1))  # the next lower group
    above = [*range(1, len(symbols)), -1]
    smaller = [-1] * n  # nearest earlier suffix in a lower group
    done = bytearray(n)
    finished: list[list[int]] = []  # groups from the highest down

    g = len(symbols) - 1
    while g >= 0:
        own = [i for i in members[g] if group_of[i] == g]
        for i in own:
            done[i] = 1
        moved: dict[tuple[int, int], list[int]] = {}
        last, repeats = -1, 0
        for i in own:  # in text order, so those that point to one suffix follow each other
            j = i - 1
            while j >= 0 and done[j]:
                j = smaller[j]
            smaller[i] = j
            if j == last:
                repeats += 1
                continue
            if last >= 0:
                moved.setdefault((group_of[last], repeats), []).append(last)
            last, repeats = j, 1
        if last >= 0:
            moved.setdefault((group_of[last], repeats), []).append(last)
        for old, _ in sorted(moved, reverse=True):  # fewer repeats are inserted later, so lower
            at = moved[old, _]
            new, top = len(members), above[old]
            members.append(at)
            below.append(old)
            above.append(top)
            above[old] = new
            if top >= 0:
                below[top] = new
            for j in at:
                group_of[j] = new
        finished.append(own)
        members[g] = []
        g = below[g]

    slot = [0] * n  # of each suffix: its group
    free: list[int] = []  # of each group: its next free place
    place = n
    for k, own in enumerate(finished):
        place -= len(own)
        free.append(place)
        for i in own:
            slot[i] = k
    order, placed = [-1] * n, bytearray(n)

    def emit(j: int) -> None:
        while j >= 0 and not placed[j]:
            placed[j] = 1
            order[free[slot[j]]] = j
            free[slot[j]] += 1
            j = smaller[j]

    emit(n - 1)  # what comes before the empty suffix
    for k in range(n):
        emit(order[k] - 1)
    return np.array(order, np.int64)
