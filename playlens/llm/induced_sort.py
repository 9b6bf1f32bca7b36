"""Suffix arrays of one shard by induced sorting, and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than their right
neighbour. The leftmost S of each run starts a substring; these substrings are
sorted by induction and named, the string of names is sorted recursively where
names repeat, and the order of all suffixes is induced from theirs in linear
time. Small alphabets are induced bucket by bucket in numpy; large ones (the
names of the recursion) are sorted by prefix doubling, all places a round.
"""

from __future__ import annotations

import numpy as np

#: Up to so many symbols, whole buckets are induced at once.
_BUCKETWISE = 1024


def smaller_types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last (the sentinel) counts as S."""
    n = len(s)
    out = np.zeros(n, bool)
    out[-1] = True
    if n > 1:
        less, differs = s[:-1] < s[1:], s[:-1] != s[1:]
        # an equal neighbour passes the type of the next place that differs
        place = np.where(differs, np.arange(n - 1), n - 1)
        place = np.minimum.accumulate(place[::-1])[::-1]
        out[:-1] = np.append(less, True)[place]
    return out


def _deal(items: np.ndarray, chars: np.ndarray, buckets: list[list[np.ndarray]]) -> None:
    """Append items to the buckets of their symbols, in order."""
    if not len(items):
        return
    order = np.argsort(chars, kind="stable")
    items, chars = items[order], chars[order]
    edges = [0, *(np.flatnonzero(chars[1:] != chars[:-1]) + 1).tolist(), len(chars)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        buckets[chars[lo]].append(items[lo:hi])


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _induce_buckets(s, k, is_s, leftmost) -> np.ndarray:
    s = s.astype(np.int16)              # few symbols: sorted by digits
    seeds: list[list[np.ndarray]] = [[] for _ in range(k)]
    _deal(leftmost, s[leftmost], seeds)
    waiting: list[list[np.ndarray]] = [[] for _ in range(k)]
    larger: list[np.ndarray] = []

    def push(items, keep_s, c, buckets):
        """Predecessors of the wanted type go to their buckets; those of symbol c come back."""
        before = items[items > 0] - 1
        before = before[is_s[before] == keep_s]
        chars = s[before]
        own = chars == c
        _deal(before[~own], chars[~own], buckets)
        return before[own]

    for c in range(k):
        wave, done = _joined(waiting[c]), []
        while len(wave):
            done.append(wave)
            wave = push(wave, False, c, waiting)
        larger.append(_joined(done))
        push(_joined(seeds[c]), False, c, waiting)
    waiting = [[] for _ in range(k)]
    waiting[s[-1]].append(np.array([len(s) - 1]))
    smaller: list[np.ndarray] = [np.zeros(0, np.int64)] * k
    for c in range(k - 1, -1, -1):
        wave, done = _joined(waiting[c]), []
        while len(wave):
            done.append(wave)
            wave = push(wave, True, c, waiting)
        smaller[c] = _joined(done)[::-1]
        push(larger[c][::-1], True, c, waiting)
    return np.concatenate([x for c in range(k) for x in (larger[c], smaller[c])])


def _by_doubling(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order: places with equal first symbols are told apart by twice as many each round."""
    n = len(s)
    order = np.argsort(s)
    fresh = np.append(True, np.diff(s[order]) != 0)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))     # the first place of its group
    live, step = np.flatnonzero(~(fresh & np.append(fresh[1:], True))), 1
    while len(live):                                # places in groups of two or more
        at = order[live]
        key = rank[at] * n + rank[at + step]        # equal so far without the last symbol, which is unique
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[live] = at
        fresh = np.append(True, np.diff(key) != 0)
        rank[at] = live[np.maximum.accumulate(np.where(fresh, np.arange(len(live)), 0))]
        live = live[~(fresh & np.append(fresh[1:], True))]
        step *= 2
    return order


def _names(s: np.ndarray, starts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names, in the order of ``starts``, of the sorted leftmost substrings: equal ones share a name."""
    length = np.empty(len(s), np.int64)
    length[starts] = np.diff(starts, append=starts[-1] + 1)   # up to the next start, which is compared too
    one, two = order[:-1], order[1:]
    equal = length[one] == length[two]
    live, step = np.flatnonzero(equal), 0
    while len(live):
        same = s[one[live] + step] == s[two[live] + step]
        equal[live[~same]] = False
        step += 1
        live = live[same & (length[one[live]] >= step)]
    name = np.empty(len(s), np.int64)
    name[order] = np.concatenate([[0], np.cumsum(~equal)])
    return name[starts]


def suffix_array(s: np.ndarray, k: int | None = None) -> np.ndarray:
    """Starts of the suffixes of ``s`` in order; ``s`` ends with a 0 that occurs nowhere else."""
    s = np.asarray(s, np.int64)
    n = len(s)
    if n < 3:
        return np.arange(n)[::-1].copy()
    k = int(s.max()) + 1 if k is None else k
    if k > _BUCKETWISE:
        return _by_doubling(s)
    is_s = smaller_types(s)
    starts = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    order = _induce_buckets(s, k, is_s, starts)
    leftmost = np.zeros(n, bool)
    leftmost[starts] = True
    order = order[leftmost[order]]
    names = _names(s, starts, order)
    if names.max() + 1 < len(names):
        order = starts[suffix_array(names)]
    return _induce_buckets(s, k, is_s, order)


def permuted_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each text position, the common prefix of its suffix with the one before it in order.

    A value is one less than that of the position before it unless the symbols
    before both suffixes differ; only at those places are symbols compared.
    """
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    here = np.arange(n)
    known = (before > 0) & (here > 0)
    follows = known & (s[np.maximum(here, 1) - 1] == s[np.maximum(before, 1) - 1])
    places = np.flatnonzero(~follows & (before >= 0))
    common = np.zeros(n, np.int64)
    live, step = places, 0
    while len(live):
        inside = (live + step < n) & (before[live] + step < n)
        live = live[inside]
        live = live[s[live + step] == s[before[live] + step]]
        step += 1
        common[live] = step
    base = np.where(follows, -1, here)
    base = np.maximum.accumulate(base)
    return np.where(base >= 0, np.maximum(common[base] - (here - base), 0), 0)
