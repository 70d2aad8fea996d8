"""Suffix sorting by linear grouping.

Baier's two phases ("Linear-time suffix sorting - a new approach for suffix array construction",
CPM 2016). Phase 1 groups suffixes by their Lyndon prefix: groups are processed in descending
order; each member's previous-smaller pointer says which suffix it extends, and suffixes extended
equally often move to a new group right above the rest of theirs. Phase 2 walks the array once and
emits each group's order along the same pointers, without renaming or recursion.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of text in lexicographic order; the last symbol is unique and least."""
    n = len(text)
    group = [0] * n  # a group is named by the array index at which it begins, so names keep the order
    members: dict[int, list[int]] = {}
    size: dict[int, int] = {}
    ending: dict[int, int] = {}  # array index at which a group ends -> its name
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by_symbol.setdefault(c, []).append(i)
    at = 0
    for c in sorted(by_symbol):
        own = by_symbol[c]
        members[at], size[at], ending[at + len(own) - 1] = own, len(own), at
        for i in own:
            group[i] = at
        at += len(own)
    smaller = [-1] * n
    i = n - 1
    while i >= 0:
        g = ending[i]
        own = members[g] if len(members[g]) == size[g] else [s for s in members[g] if group[s] == g]
        extended: dict[int, int] = {}
        for s in own:
            p = s - 1
            while p >= 0 and group[p] >= g:
                p = smaller[p]
            smaller[s] = p
            if p >= 0:
                extended[p] = extended.get(p, 0) + 1
        by_times: dict[int, dict[int, list[int]]] = {}
        for p, times in extended.items():
            by_times.setdefault(times, {}).setdefault(group[p], []).append(p)
        for times in sorted(by_times, reverse=True):
            for h, moved in by_times[times].items():
                if len(moved) == size[h]:
                    continue
                new = h + size[h] - len(moved)
                ending[h + size[h] - 1], ending[new - 1] = new, h
                size[h] -= len(moved)
                size[new] = len(moved)
                members[new] = sorted(moved)
                for p in moved:
                    group[p] = new
        i = g - 1
    order = [-1] * n
    order[0] = n - 1
    placed = [False] * n
    placed[n - 1] = True
    free = {g: g for g in members}
    for i in range(n):
        p = order[i] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            order[free[g]] = p
            free[g] += 1
            placed[p] = True
            p = smaller[p]
    return order


def common_prefixes(text: list[int], order: list[int], stop: int) -> list[int]:
    """For each array index i, equal symbols of suffixes i - 1 and i before either reaches a symbol up to stop (Kasai)."""
    n = len(text)
    rank = [0] * n
    for i, s in enumerate(order):
        rank[s] = i
    out, k = [0] * n, 0
    for s in range(n):
        if rank[s] == 0:
            k = 0
            continue
        j = order[rank[s] - 1]
        while s + k < n and j + k < n and text[s + k] == text[j + k] and text[s + k] > stop:
            k += 1
        out[rank[s]] = k
        k = max(0, k - 1)
    return out
