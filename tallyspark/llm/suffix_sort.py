"""Suffix comparison by prefix hashes, and a mergesort built on it, in numpy.

With prefix polynomial hashes the longest common extension of two suffixes is found
by binary search, so comparing two suffixes takes a logarithmic number of steps.
All suffixes of a merge level are compared at once.  Wherever hashes say that two
suffixes agree over the whole length, their bytes are compared; if they differ
after all (a collision) the exact common extension is taken instead.
"""

from __future__ import annotations

import numpy as np

_ODD = 0x9E3779B97F4A7C15
_powers = {b: np.ones(1, np.uint64) for b in (_ODD, pow(_ODD, -1, 2**64))}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling and kept."""
    known = _powers.get(base, np.ones(1, np.uint64))
    while len(known) < n:
        known = np.concatenate([known, known * np.uint64(pow(base, len(known), 2**64))])
    _powers[base] = known
    return known[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a number over all bits."""
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Prefixes:
    """Prefix polynomial hashes of a byte string, modulo 2**64."""

    def __init__(self, data: np.ndarray):
        self.data = data
        terms = (data.astype(np.uint64) + np.uint64(1)) * powers(_ODD, len(data))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.inverse = powers(pow(_ODD, -1, 2**64), len(data) + 1)

    def span(self, start: np.ndarray, size) -> np.ndarray:
        """The hash of data[start:start+size]: equal bytes give equal hashes."""
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]

    def grams(self, size: int) -> np.ndarray:
        """The mixed hash of every run of ``size`` bytes."""
        n = max(0, len(self.data) - size + 1)
        return mixed((self.sums[size : size + n] - self.sums[:n]) * self.inverse[:n])

    def common(self, x: np.ndarray, y: np.ndarray, limit: int) -> np.ndarray:
        """The common extension of suffixes x and y, up to ``limit`` (both are so long)."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), limit, np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            a, b = x[open_], y[open_]
            mid = (low[open_] + high[open_] + 1) // 2
            same = self.span(a, mid) == self.span(b, mid)
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1
        return self._verified(x, y, low, limit)

    def _verified(self, x, y, common, limit: int):
        equal = np.flatnonzero(common == limit)
        steps = np.arange(limit)
        for at in range(0, len(equal), 10_000):
            part = equal[at : at + 10_000]
            differ = self.data[x[part, None] + steps] != self.data[y[part, None] + steps]
            wrong = np.flatnonzero(differ.any(axis=1))
            common[part[wrong]] = differ[wrong].argmax(axis=1)
        return common

    def compare(self, x: np.ndarray, y: np.ndarray, limit: int) -> np.ndarray:
        """-1, 0 or 1 as the ``limit`` bytes at x come before, equal or after those at y."""
        common = self.common(x, y, limit)
        out = np.zeros(len(x), np.int8)
        open_ = np.flatnonzero(common < limit)
        at = common[open_]
        less = self.data[x[open_] + at] < self.data[y[open_] + at]
        out[open_] = np.where(less, -1, 1)
        return out


def repeated(text: Prefixes, start: np.ndarray, group: np.ndarray, limit: int) -> np.ndarray:
    """True where another suffix of the same group has the same first ``limit`` bytes.

    Bottom-up mergesort of each group by suffix order.  Two neighbouring runs are
    merged by finding the place of every suffix in the other run by binary search.
    A suffix that meets its equal is marked, and one of the two leaves the merge:
    thousands of equal suffixes shrink to one within a few levels.
    """
    mark = np.zeros(len(start), bool)
    order = np.argsort(group, kind="stable")
    run = np.arange(len(order))  # runs are numbered within a group from an even start
    first = np.concatenate([[True], group[order][1:] != group[order][:-1]]) if len(order) else np.zeros(0, bool)
    base = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0)) if len(order) else run
    run = run - base
    members, grp = order, group[order]
    while len(members):
        # Where a group has one run left it is sorted; those suffixes are done.
        last = np.concatenate([grp[1:] != grp[:-1], [True]])
        group_end = np.flatnonzero(last)
        group_of = np.searchsorted(group_end, np.arange(len(members)))
        begin = np.concatenate([[0], group_end[:-1] + 1])
        single = (run[begin] == run[group_end])[group_of]
        if single.all():
            break
        members, grp, run = members[~single], grp[~single], run[~single]
        members, grp, run = _merge(text, start, mark, members, grp, run, limit)
    return mark


def _merge(text, start, mark, members, grp, run, limit):
    """Merge run 2i with run 2i+1 of every group."""
    n = len(members)
    change = np.concatenate([[True], (grp[1:] != grp[:-1]) | (run[1:] != run[:-1])])
    begin = np.flatnonzero(change)
    size = np.diff(np.concatenate([begin, [n]]))
    index = np.cumsum(change) - 1  # the run of each member, counted over all groups
    right = run % 2 == 1
    run_group, run_number = grp[begin], run[begin]
    sibling = np.arange(len(begin)) + np.where(run_number % 2 == 1, -1, 1)
    inside = (sibling >= 0) & (sibling < len(begin))
    safe = np.where(inside, sibling, 0)
    paired = inside & (run_group[safe] == run_group) & (run_number[safe] // 2 == run_number // 2)
    low = np.where(paired[index], begin[safe][index], 0)
    high = np.where(paired[index], low + size[safe][index], low)
    floor = low.copy()
    equal = np.zeros(n, bool)
    while True:
        open_ = np.flatnonzero((low < high) & ~equal)
        if not len(open_):
            break
        mid = (low[open_] + high[open_]) // 2
        order = text.compare(start[members[open_]], start[members[mid]], limit)
        same = order == 0
        equal[open_[same]] = True
        low[open_[same]] = mid[same]
        after, before = order > 0, order < 0
        low[open_[after]] = mid[after] + 1
        high[open_[before]] = mid[before]
    mark[members[equal]] = True
    # Equal suffixes stay in the left run only.
    stays = ~(equal & right)
    rank = low - floor
    pair_begin = np.where(right & paired[index], begin[safe][index], begin[index])
    place = pair_begin + (np.arange(n) - begin[index]) + rank
    keep = np.flatnonzero(stays)
    # Left before right at equal places cannot occur: equals have left the right run.
    order = keep[np.lexsort((place[keep], run[keep] // 2, grp[keep]))]
    return members[order], grp[order], run[order] // 2
