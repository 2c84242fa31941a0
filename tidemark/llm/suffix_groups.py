"""Suffix arrays by linear grouping construction, for many strings at once.

The first phase sorts suffixes into groups of equal Lyndon prefix. It takes the
groups in descending order; for each member it finds the previous suffix of a
lower group (following the pointers of suffixes done before), and suffixes that
get equally many pointers from the group leave their old group for a new one
right above it. The second phase emits the order: from the least suffix on, the
suffix before an emitted one goes to the front of its group, and so do the ones
on its chain of previous pointers until one is already in place. No renaming,
no recursion.

All strings of a batch go through the phases in lockstep, so each step is one
array operation over the batch (numpy) instead of one over a string.
"""

from __future__ import annotations

import numpy as np


def lyndon_groups(text: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phase one. ``text``: a row of codes a string, each row ending (at
    ``size``) in a code that is its least and occurs once. Returns for every
    suffix the start of its group in the suffix array and its pointer to the
    previous suffix of a lower group (flat index, -1 for none)."""
    rows, n = text.shape
    columns = np.arange(n)
    pad = columns >= size[:, None]
    code = np.where(pad, np.iinfo(np.int32).max, text.astype(np.int32))
    order = np.argsort(code, axis=1, kind="stable")
    ordered = np.take_along_axis(code, order, 1)
    opens = np.ones((rows, n), bool)
    opens[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    begin = np.maximum.accumulate(np.where(opens, columns, 0), axis=1)
    group = np.empty((rows, n), np.int32)
    np.put_along_axis(group, order, begin.astype(np.int32), 1)
    group[pad] = -1
    held = np.zeros(rows * n + 1, np.int32)  # members of the group that starts here
    np.add.at(held, (np.arange(rows)[:, None] * n + begin)[~pad], 1)
    ends = np.zeros(rows * (n + 1), np.int32)  # start of the group that ends here
    r, c = np.nonzero(opens & ~pad)
    ends[r * (n + 1) + c + held[r * n + c]] = c
    flat = group.reshape(-1)
    prev = np.full(rows * n, -1, np.int64)
    top = size.astype(np.int64).copy()
    row0, row1 = np.arange(rows) * n, np.arange(rows) * (n + 1)
    alive = back = np.arange(rows)  # rows of `view`, which is rebuilt as strings finish
    view = group
    while len(alive):
        now = ends[row1[alive] + top[alive]]
        at = np.flatnonzero(view == now[:, None])
        which, inside = at // n, at % n
        member = row0[alive[which]] + inside
        mine = now[which]
        prev[member] = np.where(inside > 0, member - 1, -1)
        a, g = member, mine
        while len(a):
            t = prev[a]
            on = np.flatnonzero(t >= 0)
            a, g, t = a[on], g[on], t[on]
            on = np.flatnonzero(flat[t] >= g)
            a, g, t = a[on], g[on], t[on]
            prev[a] = prev[t]
        target = prev[member]
        target = np.sort(target[target >= 0])
        if len(target):
            first = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
            u = target[first]
            hits = np.diff(np.append(first, len(target)))
            old = u // n * n + flat[u]  # flat place of the old group's start
            by = np.argsort(old * (hits.max() + 1) + hits, kind="stable")
            u, hits, old = u[by], hits[by], old[by]
            new_old = np.concatenate(([True], old[1:] != old[:-1]))
            new_set = new_old | np.concatenate(([True], hits[1:] != hits[:-1]))
            s = np.flatnonzero(new_set)
            o = np.flatnonzero(new_old)
            leaving = np.diff(np.append(o, len(u)))
            stay = held[old[o]] - leaving
            of_old = np.cumsum(new_old) - 1
            # members that stay, then the sets by ascending number of pointers
            start = old[s] + stay[of_old[s]] + s - o[of_old[s]]
            many = np.diff(np.append(s, len(u)))
            rest = stay > 0
            held[old[o]] = stay
            r = old[o][rest] // n
            ends[r * (n + 1) + old[o][rest] - r * n + stay[rest]] = old[o][rest] - r * n
            held[start] = many
            r = start // n
            ends[r * (n + 1) + start - r * n + many] = start - r * n
            flat[u] = np.repeat(start - r * n, many)
            if view is not group:
                view[back[u // n], u % n] = flat[u]
        top[alive] = now
        live = now > 0
        if not live.all():
            left = alive[live]
            if len(left) < 0.7 * len(view):
                alive, view = left, group[left]
                back = np.zeros(rows, np.int64)
                back[alive] = np.arange(len(alive))
            else:  # rows that are done find no group that ends at 0
                top[alive[~live]] = 0
                ends[row1[alive[~live]]] = -2
    return group, prev


def suffix_arrays(text: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Suffix arrays of the rows of ``text`` (padded with -1). Rows as in ``lyndon_groups``."""
    rows, n = text.shape
    group, prev = lyndon_groups(text, size)
    flat = group.reshape(-1)
    front = np.tile(np.arange(n, dtype=np.int64), (rows, 1)).reshape(-1)  # next free place of the group that starts here
    placed = np.zeros(rows * n, bool)
    out = np.full(rows * n, -1, np.int64)  # flat suffixes
    row0 = np.arange(rows) * n
    out[row0] = row0 + size - 1
    placed[row0 + size - 1] = True
    front[row0 + flat[row0 + size - 1]] += 1
    for i in range(n):
        s = out[row0 + i]
        j = s[(s >= 0) & (s % n > 0)] - 1
        while len(j):
            j = j[~placed[j]]
            if not len(j):
                break
            base = j // n * n
            g = base + flat[j]
            out[base + front[g]] = j
            front[g] += 1
            placed[j] = True
            j = prev[j]
            j = j[j >= 0]
    return np.where(out >= 0, out % n, -1).reshape(rows, n)
