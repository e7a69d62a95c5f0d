"""Suffix array by groups of Lyndon prefixes, in linear time and without renaming.

The first part puts suffixes into groups by their longest Lyndon prefix. They start out
grouped by their first symbol. Groups are taken from the highest to the lowest; from each
of its suffixes a pointer goes to the nearest suffix before it in a lower group, whose
prefix ends where the suffix begins and so grows by the group's prefix, once for each of
its suffixes that point to it. Suffixes that grow leave their group for a new one right
above it.

When a group is taken its prefix is final, and a suffix is that prefix followed by the
suffix behind it, which is smaller. So in the second part a scan of the array from its
beginning emits each group in order: every suffix passes those whose prefix ends where
it begins to the next free places of their groups.
"""

from __future__ import annotations

from itertools import chain

import numpy as np


def _first_groups(symbols: np.ndarray) -> tuple[list[list[int]], list[int]]:
    """Places of each symbol but 0, by symbol, and each place's group (0 for separators)."""
    order = np.argsort(symbols, kind="stable")
    order = order[np.count_nonzero(symbols == 0) :]
    ranked = symbols[order]
    new = np.ones(len(ranked), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    group = np.zeros(len(symbols), dtype=np.int64)
    group[order] = np.cumsum(new)
    places = order.tolist()
    bounds = [*np.flatnonzero(new).tolist(), len(places)]
    members = [[], *(places[a:b] for a, b in zip(bounds, bounds[1:], strict=False))]
    return members, group.tolist()


def lyndon_groups(symbols: np.ndarray) -> tuple[list[int], list[int], int]:
    """Each place's group, numbered from the highest, and the length of its Lyndon prefix.

    The first symbol must be 0. Places of 0 belong to no group (-1).
    """
    members, group = _first_groups(symbols)
    n_groups = len(members)
    length, size = [1] * n_groups, [len(places) for places in members]
    above, below = list(range(1, n_groups + 1)), list(range(-1, n_groups - 1))
    above.append(0)  # a place for the end above the highest group
    below.append(n_groups - 1)
    length.append(0)
    size.append(0)
    members.append([])
    # the nearest place at or before each that is in no group taken so far
    open_at = list(range(len(group)))
    final, reach = [-1] * len(group), [0] * len(group)

    taken, current = 0, n_groups - 1
    while current > 0:
        places = members[current]
        if size[current]:
            if size[current] < len(places):
                places = [place for place in places if group[place] == current]
            prefix = length[current]
            for place in places:
                open_at[place] = place - 1
                final[place] = taken
                reach[place] = prefix
            taken += 1
            parts: dict[tuple[int, int], list[int]] = {}
            if len(places) == 1:
                at = places[0] - 1
                while (up := open_at[at]) != at:
                    open_at[at] = at = open_at[up]
                if low := group[at]:
                    if size[low] == 1:
                        length[low] += prefix
                    else:
                        parts[low, 1] = [at]
            else:
                counts: dict[int, int] = {}
                for place in places:
                    at = place - 1
                    while (up := open_at[at]) != at:
                        open_at[at] = at = open_at[up]
                    if group[at]:
                        counts[at] = counts.get(at, 0) + 1
                for at, times in counts.items():
                    parts.setdefault((group[at], times), []).append(at)
            # more repetitions are higher, so they are put above their group first
            for low, times in sorted(parts, reverse=True):
                grown = parts[low, times]
                if len(grown) == size[low]:
                    length[low] += times * prefix
                    if len(members[low]) > len(grown):
                        members[low] = grown
                    continue
                size[low] -= len(grown)
                new, high = len(members), above[low]
                for at in grown:
                    group[at] = new
                members.append(grown)
                length.append(length[low] + times * prefix)
                size.append(len(grown))
                above.append(high)
                below.append(low)
                above[low] = below[high] = new
        members[current] = ()
        current = below[current]
    return final, reach, taken


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Places of all symbols but 0, in the order of the suffixes up to the next 0.

    ``symbols`` are not negative and begin and end with 0, which separates strings.
    Suffixes that are equal up to their 0 come in any order.
    """
    group, reach, n_groups = lyndon_groups(symbols)
    own = np.array(group)
    n_suffixes = int(np.count_nonzero(own >= 0))
    sizes = np.bincount(own[own >= 0], minlength=n_groups)
    # groups are numbered from the highest: the first free place of each
    free = (n_suffixes - np.cumsum(sizes)).tolist()
    behind = np.arange(len(own)) + np.array(reach)
    behind[own < 0] = -1
    by_end = np.argsort(behind, kind="stable")
    bounds = np.searchsorted(behind[by_end], np.arange(len(own) + 1)).tolist()
    heads = by_end.tolist()
    array = [0] * n_suffixes

    # the array grows ahead of the scan, which the separators begin
    for end in chain(np.flatnonzero(symbols == 0).tolist(), array):
        for i in range(bounds[end], bounds[end + 1]):
            head = heads[i]
            to = group[head]
            array[free[to]] = head
            free[to] += 1
    return np.array(array, dtype=np.int64)
