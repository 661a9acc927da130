"""Linear suffix sorting by grouping, for integer sequences.

Phase one groups the suffixes by their longest prefix that is a Lyndon word.
Groups start as first symbols and are taken in descending order. A group taken
is final; each of its suffixes points to the nearest suffix before it in a
smaller group, and that one's prefix grows by the group's word, once for every
suffix that points to it. So these move up into new groups right after their
old one, more repetitions further up.

Phase two emits the order: the suffixes whose prefix ends where a sorted suffix
begins, found along the same pointers, take the next free places of their
groups. Nothing is renamed and nothing recurses.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(symbols: Sequence[int]) -> np.ndarray:
    """Starts of the suffixes of a sequence in lexicographic order; a proper prefix comes first."""
    given = np.asarray(symbols)
    n = len(given)
    if not n:
        return np.zeros(0, np.int64)
    by_symbol = np.argsort(given, kind="stable")
    sorted_ = given[by_symbol]
    heads = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    first = np.repeat(heads, np.diff(np.append(heads, n)))
    place_of = np.empty(n, np.int64)
    place_of[by_symbol] = np.arange(n)
    order, place, group = by_symbol.tolist(), place_of.tolist(), first[place_of].tolist()
    size = [0] * n
    for head, count in zip(heads.tolist(), np.diff(np.append(heads, n)).tolist(), strict=True):
        size[head] = count
    smaller = [-1] * n  # the nearest suffix before, in a smaller group

    end = n
    while end:
        head = group[order[end - 1]]
        points: dict[int, int] = {}
        for s in sorted(order[head:end]) if end - head > 1 else (order[head],):
            p = s - 1
            while p >= 0 and (g := group[p]) >= head:
                p = smaller[p]
                if g == head:
                    break
            smaller[s] = p
            if p >= 0:
                points[p] = points.get(p, 0) + 1
        end = head
        if not points:
            continue
        by_count: dict[int, list[int]] = {}
        for p, count in points.items():
            by_count.setdefault(count, []).append(p)
        for count in sorted(by_count, reverse=True):
            moved = by_count[count]
            for p in moved:  # to the end of its group
                g = group[p]
                size[g] -= 1
                last, i = g + size[g], place[p]
                q = order[last]
                order[i], order[last], place[q], place[p] = q, p, i, last
            new = [group[p] + size[group[p]] for p in moved]
            for p, g in zip(moved, new, strict=True):
                group[p] = g
                size[g] += 1

    out, free, done = [0] * n, list(range(n)), bytearray(n)
    p = n - 1
    for i in range(-1, n - 1):
        if i >= 0:
            p = out[i] - 1
        while p >= 0 and not done[p]:
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            done[p] = 1
            p = smaller[p]
    return np.array(out)
