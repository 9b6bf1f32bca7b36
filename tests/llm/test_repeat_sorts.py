"""Sorts of the repeated-bytes operator that work on whole arrays, against plain ones."""

import sys

import numpy as np
import pytest

from playlens.llm import common as C
from playlens.llm import induced_sort as I


@pytest.mark.parametrize("symbols", [2, 5, 2000])
def test_doubling_sorts_suffixes(symbols):
    r = np.random.default_rng(symbols)
    for n in (1, 2, 30, 300):
        s = np.append(r.integers(1, symbols, n), 0)
        order = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        assert I._by_doubling(s).tolist() == order == I.suffix_array(s).tolist()
    run = np.append(np.ones(5000, int), 0)
    assert I._by_doubling(run).tolist() == list(range(5000, -1, -1))


def test_large_alphabets_take_no_step_for_each_suffix():
    s = np.append(np.random.default_rng(7).permutation(20_000) + 1, 0)
    lines = 0

    def count(frame, event, arg):
        nonlocal lines
        lines += event == "line"
        return count

    before = sys.gettrace()
    sys.settrace(count)
    try:
        I.suffix_array(s)
    finally:
        sys.settrace(before)
    assert lines < 2_000


def test_order_by_is_a_lexicographic_sort():
    r = np.random.default_rng(11)
    for n in (0, 1, 40, 500):
        keys = [r.integers(-4, top, n) for top in (3, 60, 5)] + [np.arange(n)]
        assert C.order_by(*keys).tolist() == np.lexsort(keys[::-1]).tolist()
    assert C.least_by((np.array([2, 1, 2, 1], np.uint64),), np.array([5, 6, 4, 6])).tolist() == [1, 2]


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 200])
def test_window_hashes(n):
    hashed = C.RangeHash(C.BYTE_VALUES[np.arange(n) % 7])
    start = np.arange(max(0, n - 32 + 1))
    assert hashed.windows(32).tolist() == hashed(start, start + 32).tolist()


def test_covered_counts_starts_that_come_twice():
    assert C.covered(np.array([3, 0, 3], np.int64), 2, 6).tolist() == [True, True, False, True, True, False]
    assert not C.covered(np.zeros(0, np.int64), 4, 3).any()
