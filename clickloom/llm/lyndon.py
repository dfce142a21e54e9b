"""Suffix arrays by linear grouping: suffixes are grouped by their longest Lyndon prefix, then each group is put in order.

Groups are taken in descending order. A suffix of the taken group points to the nearest earlier suffix of a lower group
(its previous-smaller pointer); that suffix's Lyndon prefix grows by the group's, as often as suffixes point to it, and
it moves to a group of its own just above its old one. When all groups are taken, one ascending sweep emits the order:
a placed suffix puts the one before it at the front of its group, and so on along the pointers. No renaming, no
recursion, a constant number of steps per suffix.
"""

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The suffixes of a sequence of numbers in order; a suffix that is a prefix of another comes first."""
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64)
    # A closing symbol below all others.
    text = np.append(np.unique(symbols, return_inverse=True)[1].ravel() + 1, 0)
    order = np.argsort(text, kind="stable")
    sizes = np.bincount(text)
    first = np.cumsum(sizes) - sizes
    place = np.empty(n + 1, np.int64)
    place[order] = np.arange(n + 1)
    group = first[text].tolist()
    size = np.zeros(n + 1, np.int64)
    size[first] = sizes
    order, place, size = order.tolist(), place.tolist(), size.tolist()
    pointer = [-1] * (n + 1)

    end = n
    while end > 0:
        start = group[order[end]]
        members = order[start:end + 1]
        members.sort()
        # How many members point to each earlier suffix; equal neighbours in a chain point to the same one.
        counts = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = pointer[p]
            pointer[i] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        end = start - 1
        if not counts:
            continue
        levels = {}
        for p, k in counts.items():
            levels.setdefault(k, []).append(p)
        for k in sorted(levels, reverse=True):
            grown = {}
            for p in levels[k]:
                old = group[p]
                left = size[old] - 1
                size[old] = left
                to, at = old + left, place[p]
                if to != at:
                    other = order[to]
                    order[at], place[other] = other, at
                    order[to], place[p] = p, to
                if old in grown:
                    grown[old].append(p)
                else:
                    grown[old] = [p]
            for old, moved in grown.items():
                new = old + size[old]
                size[new] = len(moved)
                for p in moved:
                    group[p] = new
    out = [-1] * (n + 1)
    out[0] = n
    head = list(range(n + 1))
    done = bytearray(n + 1)
    done[n] = 1
    for i in range(n + 1):
        s = out[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            out[head[g]] = s
            head[g] += 1
            done[s] = 1
            s = pointer[s]
    return np.array(out[1:], np.int64)
