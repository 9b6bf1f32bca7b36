"""Token counts and byte-level BPE against the public libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from playlens.llm import op1_token_counts as counts
from playlens.llm import op4_byte_bpe as bpe

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = [" ", "  ", "\n", "a", "Zq", "'s", "'ll", "1", "23", "!", "é", "<|endoftext|>", "<|end", "ʰ", "՘", "漢字", "🙂",
         "\x1c", "\x85", "　", "的", "ñ", "א", "ก", "word", " the", "======"]


def texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)]


SPECIAL = ["", " ", None, "a" * 3000, "=" * 900, "x1" * 500, "<|endoftext|>", " \n \n\n", "é" * 300]


def test_counts_match_the_library(frame):
    library = Tokenizer.from_file(JSON)
    rows = list(enumerate(SPECIAL + texts(300, 1))) + [(None, "no id"), (1, " ")]
    got = counts.token_counts(frame(rows), JSON).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert counts.token_counts(frame([]), JSON).count() == 0


def test_whole_tokens_are_proven():
    vocabulary = counts.Vocabulary(JSON)
    library = Tokenizer.from_file(JSON)
    some = random.Random(4).sample(sorted(vocabulary.whole), 2000)
    assert "the" in vocabulary.whole and len(vocabulary.merge("qzqz")) > 1
    spare = [w for w in some if len(library.encode(w, add_special_tokens=False).ids) != 1]
    # a proven string is one token wherever it is one pre-token
    assert all(len(library.pre_tokenizer.pre_tokenize_str(w)) > 1 for w in spare)


def test_memory_of_counts_is_bounded(monkeypatch):
    monkeypatch.setattr(counts, "MEMORY", 3)
    count = counts.counter(counts.Vocabulary(JSON))
    library = Tokenizer.from_file(JSON)
    for t in texts(50, 2):
        assert count(t) == len(library.encode(t, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_ids_and_round_trip_match_the_library(frame, encoding):
    rows = list(enumerate(SPECIAL + texts(120, 3))) + [(None, "no id"), (None, "no id")]
    got = sorted((tuple(r) for r in bpe.encoded_digests(frame(rows), RANKS).collect()), key=str)
    want = []
    for i, t in rows:
        ids = encoding.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_token_rows_and_small_chunks(frame, encoding, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 600)
    rows = list(enumerate(texts(60, 5)))
    out = {r.doc_id: r for r in bpe.token_ids(frame(rows), RANKS).collect()}
    assert all(out[i].ids == encoding.encode_ordinary(t) and out[i].decoded == t for i, t in rows)
    assert bpe.token_ids(frame([]), RANKS).count() == 0


def test_merge_takes_the_least_rank_leftmost_first(encoding):
    ranks = bpe.read_ranks(RANKS)
    r = random.Random(9)
    for _ in range(300):
        raw = bytes(r.choice(b"abcdee  =='st") for _ in range(r.randint(1, 30)))
        pieces = counts.merge([bytes([b]) for b in raw], lambda a, b: ranks.get(a + b))
        assert [ranks[p] for p in pieces] == encoding._encode_single_piece(raw)


def test_spelled_out_pattern_equals_the_named_classes():
    import regex

    split, named = counts.splitter(), regex.compile(public_tokenizers.PATTERN).findall
    letters = [chr(c) for c in range(counts.SAME_CLASSES + 1)]
    r = random.Random(11)
    for _ in range(3000):
        text = "".join(r.choice(letters) for _ in range(30))
        assert split(text) == named(text)
