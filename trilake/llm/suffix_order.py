"""Linear grouping construction of suffix arrays, for many short strings at once.

A suffix's *context* is its longest Lyndon prefix: the text up to the next smaller suffix.
Phase 1 sorts suffixes into groups of equal context. Groups start as the first symbols and
are processed in descending order. For each suffix of the group, the *previous smaller*
pointer leads to the nearest earlier suffix of a lower group; each suffix so pointed at has
a context that ends where the group's begins, so its context grows by as many repeats of
the group's context as there are pointers to it, and it moves to a group right behind its
old one, further behind the more repeats it has. Phase 2 emits the order: the sorted
suffixes are read from the smallest, and the suffix before each, then its chain of previous
smaller pointers, take the front places of their groups. No step renames and recurses.

The strings are independent, so each step handles the current group of every string at
once with array operations; the last few long strings are emitted by a plain loop.
"""

from __future__ import annotations

import numpy as np

#: Strings still being emitted below which a plain loop is faster.
NARROW = 48


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(int(ends[-1])) + np.repeat(first - ends + size, size)


def _groups(sym: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Phase 1: (group, previous) of every position; a group is named by its first place."""
    n = len(sym)
    string = np.repeat(np.arange(len(start)), end - start)
    key = string << np.int64(16) | sym
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    fresh = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(np.append(fresh, n))
    group = np.full(n + 1, -1, np.int64)  # the last place stands for "none"
    group[order] = np.repeat(fresh, sizes)
    after = np.zeros(n + 1, np.int64)  # a group's end, by its first place
    after[fresh] = fresh + sizes
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    previous = np.arange(-1, n, dtype=np.int64)
    previous[start] = n
    previous[n] = n
    target, current = np.zeros(n, bool), np.zeros(n, bool)
    low, top = start.copy(), end.copy()
    while len(low):
        first = group[order[top - 1]]
        members = order[_ranges(first, top - first)]
        own = group[members]
        to = previous[members]
        while True:  # pointers lead over suffixes of this group and of higher ones
            on = group[to] >= own
            if not on.any():
                break
            to = np.where(on, previous[to], to)
            previous[members] = to
        previous[members] = to
        top = first
        more = top > low
        if not more.all():
            low, top = low[more], top[more]
        to = to[to < n]
        if not len(to):
            continue
        to.sort()
        cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        times = np.diff(np.append(cut, len(to)))
        moved = to[cut]
        old = group[moved]
        by = np.lexsort((times, old))
        moved, times, old = moved[by], times[by], old[by]
        head = np.concatenate([[True], old[1:] != old[:-1]])
        at = np.flatnonzero(head)
        count = np.diff(np.append(at, len(old)))
        tail = after[old[at]] - count  # where the moved suffixes of each old group begin
        goal = _ranges(tail, count)
        # swap the moved suffixes with those that stand in their goal places
        have = place[moved]
        target[goal], current[have] = True, True
        vacant = np.sort(have[~target[have]])
        evicted = order[goal[~current[goal]]]
        target[goal], current[have] = False, False
        order[vacant], place[evicted] = evicted, vacant
        order[goal], place[moved] = moved, goal
        after[old[at]] = tail
        run = np.flatnonzero(head | np.concatenate([[True], times[1:] != times[:-1]]))
        length = np.diff(np.append(run, len(moved)))
        group[moved] = np.repeat(goal[run], length)
        after[goal[run]] = goal[run] + length
    return group, previous


def _emit_loop(out, i, j, end, low, group, front, placed, previous):
    """Phase 2 for one string, from its place i and suffix j."""
    while True:
        while j >= low and not placed[j]:
            g = group[j]
            at = front[g]
            out[at] = j
            front[g] = at + 1
            placed[j] = True
            j = previous[j]
            if j >= end:
                break
        i += 1
        if i >= end:
            return
        j = out[i] - 1


def suffix_order(sym: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The suffix arrays of the strings that begin at ``start`` in ``sym``, one behind the
    other, as positions in ``sym``. Every string ends with 0, which it has nowhere else."""
    n = len(sym)
    end = np.append(start[1:], n)
    group, previous = _groups(sym.astype(np.int64), start, end)
    out = np.full(n, -1, np.int64)
    placed = np.zeros(n + 1, bool)
    placed[n] = True
    front = np.arange(n + 1)
    out[start] = end - 1
    placed[end - 1] = True
    front[start] += 1
    i, j, low, high = start.copy(), end - 2, start, end
    while len(i) > NARROW:
        go = (j >= low) & ~placed[j]
        x = j[go]
        if len(x):
            g = group[x]
            at = front[g]
            out[at] = x
            front[g] = at + 1
            placed[x] = True
            j[go] = previous[x]
        stay = ~go
        i = i + stay
        if (i >= high).any():
            on = i < high
            i, j, low, high, stay = i[on], j[on], low[on], high[on], stay[on]
        j[stay] = out[i[stay]] - 1
    for a, b, c, d in zip(i.tolist(), j.tolist(), low.tolist(), high.tolist()):
        s = slice(c, d)
        # lists of this string alone, in its own places
        o = (out[s] - c).tolist()
        p = previous[s]
        p = np.where(p >= n, d, p) - c
        _emit_loop(o, a - c, (b if b < n else d) - c if b >= c else -1, d - c, 0, (group[s] - c).tolist(),
                   (front[s] - c).tolist(), placed[s].tolist() + [True], p.tolist())
        out[s] = np.array(o) + c
    return out
