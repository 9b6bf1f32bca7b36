"""Token counts of a byte-level BPE tokenizer with the whole-token shortcut.

Offline, every vocabulary string is merged by itself; those that come out as
one token are the proven whole tokens. At run time a pre-token that is one of
them counts one without any merging, and only the rest are merged (each worker
keeps the counts of the pre-tokens it has seen, up to ``MEMORY`` of them). Texts
stay where they are: there is no shuffle.

Edge cases: a null or empty text has 0 bytes and 0 tokens; special strings
inside a text count one token each, as the library's default has it; a very
long pre-token is merged in n log n time; rows that repeat are counted each;
a null id passes through; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from playlens.llm import common as C

LIMIT = 512
#: Pre-tokens whose counts a worker keeps; beyond that it starts anew.
MEMORY = 500_000
#: Up to this code point the installed pattern engine and the library class all characters alike.
SAME_CLASSES = 0x52F


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(0x100 + n)
    return [letters[b] for b in range(256)]


def merge(pieces: list, rank) -> list:
    """Merge neighbours by least rank, the leftmost first; ``rank(a, b)`` is None where no merge exists."""
    n = len(pieces)
    if n < 2:
        return pieces
    pieces, after, before = list(pieces), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(pieces, pieces[1:])) if (r := rank(a, b)) is not None]  # noqa: B905
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if pieces[i] != a or j >= n or pieces[j] != b:
            continue                                     # one of the two has been merged meanwhile
        pieces[i], pieces[j] = a + b, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := rank(a + b, pieces[k])) is not None:
                heapq.heappush(heap, (r, i, a + b, pieces[k]))
        if (h := before[i]) >= 0 and (r := rank(pieces[h], a + b)) is not None:
            heapq.heappush(heap, (r, h, pieces[h], a + b))
    return [p for p in pieces if p is not None]


class Vocabulary:
    """Merge ranks, proven whole tokens and special strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, cut = file["model"], file["pre_tokenizer"]
        if (model["type"], cut["type"], cut["add_prefix_space"], cut["use_regex"], file["normalizer"]) != (
                "BPE", "ByteLevel", False, True, None):
            raise ValueError("only byte-level BPE files without a normalizer are supported")
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.ranks = {pair: n for n, pair in enumerate(pairs)}
        self.special = [t["content"] for t in file["added_tokens"]]
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.whole = set()
        for word in model["vocab"]:
            if len(self.merge(word)) == 1:
                try:
                    self.whole.add(bytes(byte_of[c] for c in word).decode())
                except (UnicodeDecodeError, KeyError):   # part of a character: never a pre-token
                    pass

    def merge(self, word: str) -> list[str]:
        return merge(list(word), lambda a, b: self.ranks.get((a, b)))


class _Counts(dict):
    """Tokens of each pre-token: one for the whole tokens, merged on first sight for the rest."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.letters = vocabulary, byte_letters()

    def __missing__(self, word: str) -> int:
        if word in self.vocabulary.whole:
            n = 1
        else:
            n = len(self.vocabulary.merge("".join(map(self.letters.__getitem__, word.encode()))))
        if len(self) >= MEMORY:
            self.clear()
        if len(word) <= 64:
            self[word] = n
        return n


@cache
def _spelled_out(pattern: str) -> str:
    """The pattern with its character classes written as ranges, for characters up to ``SAME_CLASSES``."""
    classes = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        is_one = regex.compile(name).match
        members = {c for c in range(SAME_CLASSES + 1) if is_one(chr(c))}
        heads = sorted(c for c in members if c - 1 not in members)
        tails = sorted(c for c in members if c + 1 not in members)
        classes[name] = "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(heads, tails, strict=True))
    inner = pattern.replace(r"[^\s\p{L}\p{N}]", "[^" + "".join(classes[k] for k in (r"\s", r"\p{L}", r"\p{N}")) + "]")
    for name, ranges in classes.items():
        inner = inner.replace(name, f"[{ranges}]")
    return inner.replace(r"\S", f"[^{classes[chr(92) + 's']}]")


def splitter():
    """A function from text to its pre-tokens (matches of the pattern).

    Texts up to ``SAME_CLASSES`` are split by the standard engine, with classes
    spelled out (it is twice as fast as one that knows them by name). A text
    with newer characters, which engines may class differently, is split by the
    tokenizer library.
    """
    by_engine = re.compile(_spelled_out(public_tokenizers.PATTERN)).findall
    newer = re.compile(f"[^\\x00-{chr(SAME_CLASSES)}]").search
    by_library = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str

    def split(text: str) -> list[str]:
        if newer(text):                                  # letters stand for bytes there; the text is at the offsets
            return [text[a:b] for _, (a, b) in by_library(text)]
        return by_engine(text)

    return split


def counter(vocabulary: Vocabulary):
    """A function from text to its number of tokens."""
    pre_tokens = splitter()
    special = regex.compile("|".join(map(regex.escape, vocabulary.special)) or r"(?!)")
    counts = _Counts(vocabulary)

    def count(text: str) -> int:
        parts = special.split(text)
        return len(parts) - 1 + sum(map(counts.__getitem__, (w for p in parts for w in pre_tokens(p))))

    return count


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row, for the tokenizer file at ``path`` (read by the driver)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(path))     # bounded by the vocabulary file
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = slim.drop("text").withColumns({"n_bytes": F.lit(0).cast("long"), "n_tokens": F.lit(0).cast("long"),
                                            "over_limit": F.lit(False)}).schema

    def run(batches):
        count = counter(shared.value)
        for batch in batches:
            sizes, tokens = [], []
            for text in batch.column(1):
                raw = text.as_buffer() if text.is_valid else b""
                sizes.append(len(raw))
                tokens.append(count(text.as_py()) if len(raw) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())], names=schema.names)

    return slim.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return token_counts(C.read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
