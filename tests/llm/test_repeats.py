"""Repeated passages (words) and byte strings against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from playlens.llm import common as C
from playlens.llm import op5_suffix_dedup as suffixes
from playlens.llm import op6_substring_dedup as passages
from playlens.llm.induced_sort import permuted_prefixes, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def passages_by_force(rows, window=13):
    late = 1 << 62
    words = [(i if i is not None else late, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for j in range(len(w) - window + 1):
            key = tuple(w[j:j + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, w), (real, _) in zip(words, rows, strict=True):
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j:j + window])] < i:
                gone[j:j + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((real, len(w), sum(gone), sha(kept.encode())))
    return out


def bytes_by_force(rows, width=100):
    late = 1 << 62
    texts = [(i if i is not None else late, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for j in range(len(t) - width + 1):
            first[t[j:j + width]] = min(first.get(t[j:j + width], (i, j)), (i, j))
    out = []
    for (i, t), (real, _) in zip(texts, rows, strict=True):
        gone = bytearray(len(t))
        for j in range(len(t) - width + 1):
            if first[t[j:j + width]] < (i, j):
                gone[j:j + width] = b"\1" * width
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        out.append((real, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def some_rows(seed, n=60):
    r = random.Random(seed)
    vocabulary = ["a", "of", "the", "é", "straße", "Wort", "x.", "ñ,"] + [f"w{k}" for k in range(40)]
    passage = [" ".join(r.choice(vocabulary) for _ in range(r.randint(5, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [r.choice(passage) if r.random() < 0.5 else " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 40)))
                 for _ in range(r.randint(0, 4))]
        rows.append((i, r.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "one two"), (104, "ab " * 400), (105, "ab " * 30), (106, "=" * 700)]
    rows += [(107, "z" * 40 + "é" * 90), (None, passage[0] + " tail"), (None, passage[0] + " tail"), (3, rows[3][1]), (108, rows[0][1])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 1500])
def test_passages_match_brute_force(frame, monkeypatch, chunk_bytes):
    monkeypatch.setattr(passages, "CHUNK_BYTES", chunk_bytes)
    rows = some_rows(1)
    got = [tuple(x) for x in passages.substring_dedup(frame(rows)).collect()]
    assert sorted(got, key=str) == sorted(passages_by_force(rows), key=str)


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 1500])
def test_byte_strings_match_brute_force(frame, monkeypatch, chunk_bytes):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", chunk_bytes)
    rows = some_rows(2, 40)
    got = [tuple(x) for x in suffixes.suffix_dedup(frame(rows)).collect()]
    assert sorted(got, key=str) == sorted(bytes_by_force(rows), key=str)


def test_short_slices_change_nothing(frame, monkeypatch):
    rows = some_rows(3, 30)
    monkeypatch.setattr(C, "SLICE_BYTES", 64)   # read in the driver only; slices are checked below
    column = frame(rows).select("text").toArrow().column(0)
    whole = [bytes(d[a:b]) for _, d, at in C.text_slices(column) for a, b in zip(at[:-1], at[1:], strict=True)]
    small = [bytes(d[a:b]) for _, d, at in C.text_slices(column, 64) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert whole == small == [(t or "").encode() for _, t in rows]


def test_empty_tables(frame):
    assert passages.substring_dedup(frame([])).count() == 0
    assert suffixes.suffix_dedup(frame([])).count() == 0
    assert passages.remove_repeats(frame([])).count() == 0


def test_remove_repeats_keeps_columns_and_rest(frame):
    shared = " ".join(f"p{k}" for k in range(20))
    rows = [(1, "head\n" + shared), (2, "own  words\n" + shared + "\n\nand more"), (3, "nothing shared here"), (4, None)]
    out = {r.doc_id: r for r in passages.remove_repeats(frame(rows)).collect()}
    assert out[1].text == rows[0][1] and out[3].text == rows[2][1] and out[4].text is None
    assert out[2].text == "own  words\nand more" and out[2].n_words == "x"


def test_suffix_array_and_prefixes():
    r = random.Random(1)
    for turn in range(200):
        k = r.choice([1, 2, 3, 20])
        s = [r.randint(1, k) for _ in range(r.randint(0, 50))]
        s = np.array(s + (s[: len(s) // 2] if turn % 2 else []) + [0])
        t = s.tolist()
        want = sorted(range(len(t)), key=lambda i: t[i:])
        assert suffix_array(s).tolist() == want == suffix_array(s, 5000).tolist()
        common = permuted_prefixes(s, np.array(want))
        for x, y in zip(want, want[1:], strict=False):
            n = 0
            while x + n < len(t) and y + n < len(t) and t[x + n] == t[y + n]:
                n += 1
            assert common[y] == n


def test_windows_share_anchors():
    r = np.random.default_rng(0)
    seeds = r.integers(0, 1 << 63, 500, dtype=np.uint64)
    seeds[200:260] = seeds[20:80]
    valid = np.ones(500, bool)
    valid[490:] = False
    anchor, first, last = C.anchors(seeds, valid, 9)
    of = np.zeros(500, int)
    for a, lo, hi in zip(anchor, first, last, strict=True):
        of[lo:hi + 1] = a
    assert (of[200:252] - 180 == of[20:72]).all()
    assert all(seeds[of[i]] == seeds[i:i + 9].min() for i in range(490))
