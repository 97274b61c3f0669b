"""Suffix array by linear grouping (Lyndon-prefix groups), without recursion or renaming.

Phase 1 keeps the suffixes in an array of groups, groups in lexicographic
order.  Groups are taken from the highest down.  For every suffix s of the
taken group, prev(s) is the nearest position to the left in a lower group.
The prefix known of prev(s) ends where s begins, so it grows by the prefix of
s, once for every s that points to it; it moves to a group right above its
old one, higher for more repeats.  In the end every suffix lies in the group
of its longest Lyndon prefix.

Phase 2 emits the order inside the groups: in ascending order of the suffixes
already placed, position j places j - 1, prev(j - 1), prev(prev(j - 1)), ...
at the next free place of their groups until it meets one already placed.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of an array of small non-negative integers, in order.

    The end of the text is smaller than any symbol.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(text, kind="stable")
    count = np.bincount(text)
    start_of = np.cumsum(count) - count
    place = order.tolist()                      # suffixes by group
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    at = at.tolist()                            # place of each suffix
    group = start_of[text].tolist()             # first place of each suffix's group
    size = np.zeros(n, np.int64)
    size[start_of[count > 0]] = count[count > 0]
    size = size.tolist()                        # by first place
    prev = [-1] * n

    end = n
    while end:
        first = group[place[end - 1]]
        if end - first == 1:
            p = place[first] - 1
            while p >= 0 and group[p] >= first:
                p = prev[p]
            prev[place[first]] = p
            if p >= 0:
                g = group[p]
                size[g] = last = size[g] - 1
                if last:
                    last += g
                    a, q = at[p], place[last]
                    place[a], at[q] = q, a
                    place[last], at[p] = p, last
                    group[p], size[last] = last, 1
                else:
                    size[g] = 1
            end = first
            continue
        times: dict[int, int] = {}
        for s in sorted(place[first:end]):
            p = s - 1
            while p >= 0 and group[p] >= first:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        end = first
        if times:
            most = max(times.values())
            if most == 1:
                _raise(times, place, at, group, size)
            else:
                by: dict[int, list[int]] = {}
                for p, k in times.items():
                    by.setdefault(k, []).append(p)
                for k in sorted(by, reverse=True):
                    _raise(by[k], place, at, group, size)

    # phase 2
    result, free, done = [0] * n, group, bytearray(n)
    nxt = {}
    j, k = n, 0
    while True:
        s = j - 1
        while s >= 0 and not done[s]:
            g = free[s]
            t = nxt.get(g, g)
            result[t] = s
            nxt[g] = t + 1
            done[s] = 1
            s = prev[s]
        if k == n:
            break
        j = result[k]
        k += 1
    return np.array(result, np.int64)


def _raise(moved, place: list, at: list, group: list, size: list) -> None:
    """Moves suffixes to new groups right above their present ones."""
    old = [group[p] for p in moved]
    for p, g in zip(moved, old):
        size[g] = last = size[g] - 1
        last += g
        a, q = at[p], place[last]
        place[a], at[q] = q, a
        place[last], at[p] = p, last
    new = [g + size[g] for g in old]
    for p, g in zip(moved, new):
        group[p] = g
        size[g] += 1
