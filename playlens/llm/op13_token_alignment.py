"""Alignment of two tokenizers over the distinct texts of the corpus.

1. The shuffle is by full text: equal texts become one row with their
   multiplicity before anything is tokenised.
2. Each distinct text is tokenised and aligned once. Both tokenizers cut a text
   wherever a space or line end follows a character that is not white space, and
   where a sign follows a letter (the byte-level pattern never matches across such
   a place, and no piece of the other vocabulary reaches across one: checked when
   it is loaded). The stretches between, *units*, are encoded by the libraries and
   aligned on their bytes, each distinct unit of a block once; a text is its
   sequence of units. Byte offsets where tokens of both end cut groups; every
   elementary interval between ends of either is one link.
3. A block reports each linked id pair with the multiplicities of the texts that
   hold it. The pairs are summed over the corpus; the best count of each A id
   follows (one row for each id at most: bounded by the vocabulary, broadcast).
4. Counts go back to the blocks that asked, and each text sums them over its links.
5. The measures join the documents on the text's SHA-256.

Edge cases: null and empty texts, and texts whose joined tokens differ from
space + text (the character U+2581, for one), have zeros and an empty digest;
they lend no counts. Special strings are plain text. Repeated rows count each,
and a null id passes through. A very long text is one row and one unit sequence;
a block ends after it. Ties for the best count all count. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playlens.llm import common as C
from playlens.llm.op1_token_counts import SAME_CLASSES, byte_letters

#: Text bytes of a block: one dictionary of units and of id pairs.
BLOCK_BYTES = 8 << 20
#: Units that one call of a library encodes in a row.
ROW = 1024
#: Units whose alignment a worker keeps (about 150 bytes each); beyond that it starts anew.
SEEN = 1_000_000
#: A pair of ids is one long: the A id above, the B id in the low bits.
B_BITS = 20
MARK = "▁"
#: Written before a row of units: both cut after it, wherever a unit can begin.
HEAD = " a"
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

_BLOCKS = "block long, texts binary, units binary"


class Tokenizers:
    """Both libraries' encoders, and the bytes of every token."""

    def __init__(self, file_a: str, file_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"         # a task has one core
        self.a = Tokenizer.from_str(file_a)
        self.a.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        file = json.loads(file_a)
        vocabulary, cut = file["model"]["vocab"], file["pre_tokenizer"]
        if file["normalizer"] or (cut["type"], cut["add_prefix_space"], cut["use_regex"]) != ("ByteLevel", False, True):
            raise ValueError("A must be a byte-level file without a normalizer, split by the pattern")
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for word, n in vocabulary.items():
            self.a_bytes[n] = bytes(byte_of.get(c, 0) for c in word)
        self.fast = _by_ranks(file, byte_of, public_tokenizers.PATTERN)
        self.newer = re.compile(f"[^\\x00-{chr(SAME_CLASSES)}]").search
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(f"[^{MARK}]{MARK}|.\n|\n.", p) for p in pieces):
            raise ValueError("a piece of B crosses the white space between words; units are not independent")
        #: signs that no piece of B has after a letter
        self.signs = [c for c in ".,;:!?" if not any(re.search(f"[A-Za-z]{re.escape(c)}", p) for p in pieces)]
        if len(pieces) > 1 << B_BITS:
            raise ValueError("B has too many ids")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # each id with the sign that may follow it in the text form of the groups
        self.signed = [b"%d%s" % (i, end) for side, ends in ((self.a_bytes, b",|"), (self.b_bytes, b",;"))
                       for end in (ends[:1], ends[1:]) for i in range(len(side))]
        self.signed_size = np.array([len(x) for x in self.signed], np.int64)

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids, where each unit's begin, B ids, where each unit's begin, whether the tokens of both join to the unit)."""
        # units that may follow each other in any order are written in a row; the rest come alone
        rest = [n for n, u in enumerate(units) if u[0] not in " \n" or u[-1].isspace()]
        apart = set(rest)
        order = [n for n in range(len(units)) if n not in apart] + rest
        many = [units[n] for n in order[: len(order) - len(rest)]]
        found = [self._encode_row(many[lo: lo + ROW]) for lo in range(0, len(many), ROW)]
        found += [self._encode_row([units[n]]) for n in rest]
        ids_a, size_a, ids_b, size_b, ok = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found, strict=True)) \
            if found else (np.zeros(0, np.int64),) * 5
        back = np.empty(len(units), np.int64)
        back[order] = np.arange(len(units))
        out = []
        for ids, size in ((ids_a, size_a), (ids_b, size_b)):
            at = np.concatenate([[0], np.cumsum(size)])
            out += [ids[_ragged(back, at)], np.concatenate([[0], np.cumsum(size[back])])]
        return (*out, ok[back].astype(bool))

    def _ids_a(self, text: str) -> list[int]:
        if self.fast is not None and not self.newer(text):
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def _encode_row(self, units: list[str]):
        """A ids and their number by unit, B ids and theirs, and which units came out whole."""
        text = HEAD + "".join(units)
        raw = text.encode()
        a, b = self._ids_a(text), self.b.encode(text[1:], num_threads=1)        # B adds the first space itself
        if b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw:
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            sizes = [len(u) for u in units] if len(raw) == len(text) else [len(u.encode()) for u in units]
            edge = np.cumsum([len(HEAD), *sizes])
            ends = [np.searchsorted(np.cumsum(size[ids]), edge) + 1 for ids, size in ((a, self.a_size), (b, self.b_size))]
            return a[ends[0][0]:], np.diff(ends[0]), b[ends[1][0]:], np.diff(ends[1]), np.ones(len(units), np.int64)
        if len(units) > 1:                                   # at least one does not: find it by halves
            half = len(units) // 2
            return tuple(map(np.concatenate, zip(self._encode_row(units[:half]), self._encode_row(units[half:]), strict=True)))
        none, zero = np.zeros(0, np.int64), np.zeros(1, np.int64)
        return none, zero, none, zero, zero


def _by_ranks(file: dict, byte_of: dict[str, int], pattern: str):
    """The rank library's encoder, three times as fast, if the file's ids are its merge ranks; else None.

    Its pattern engine may class newer characters in another way: texts that
    have any are left to the file's own library.
    """
    vocabulary = file["model"]["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in file["model"]["merges"]]
    single = [w for w in vocabulary if len(w) == 1]
    if [vocabulary.get(x + y) for x, y in merges] != list(range(256, 256 + len(merges))) or (
            sorted(vocabulary[w] for w in single) != list(range(256)) or any(w not in byte_of for w in single)):
        return None
    ranks = {bytes(byte_of[c] for c in w): n for w, n in vocabulary.items() if n < 256 + len(merges)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def unit_starts(data: np.ndarray, at: np.ndarray, signs: list[str]) -> np.ndarray:
    """Where units begin in UTF-8 texts: places where both tokenizers cut whatever lies around.

    Those are the starts of texts, spaces and line ends after a character other
    than white space, and ``signs`` after an ASCII letter.
    """
    kind = np.zeros(256, np.uint8)                           # of a character that ends in the byte: 1 no white space, 2 letter
    kind[0x21:0x7F] = 1
    kind[0x80:] = 1
    kind[[*range(65, 91), *range(97, 123)]] = 2
    kind[[0x20, 0x0A]] = 3
    kind[[ord(c) for c in signs]] = 4                        # no white space either
    kind = kind[data]
    cuts = np.zeros(64, bool)
    cuts[[3 * 8 + 1, 3 * 8 + 2, 3 * 8 + 4, 4 * 8 + 2]] = True
    start = np.zeros(len(data), bool)
    start[1:] = cuts[kind[1:] << 3 | kind[:-1]]
    # white space beyond ASCII is C2 85, C2 A0 or three bytes from E1, E2 or E3: places after such bytes count as inside
    high = np.flatnonzero(start)
    high = high[data[high - 1] >= 0x80]
    start[high[(data[high - 2] == 0xC2) | ((data[high - 3] >= 0xE1) & (data[high - 3] <= 0xE3))]] = False
    start[at[:-1]] = True
    return np.flatnonzero(start)


class AlignedUnits:
    """The alignment of a list of units: counts, text forms and linked pairs of each."""

    def __init__(self, words: list[str], both: Tokenizers):
        ids_a, at_a, ids_b, at_b, self.ok = both.encode(words)
        end_a, end_b = np.cumsum(both.a_size[ids_a]), np.cumsum(both.b_size[ids_b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        either = np.union1d(end_a, end_b)
        self.pairs = (ids_a[np.searchsorted(end_a, either)] << B_BITS) | ids_b[np.searchsorted(end_b, either)]
        # bytes at which each unit ends; an empty unit ends where the one before does
        edge = np.concatenate([[0], end_a])[at_a]
        self.at = np.searchsorted(either, edge, "right")            # the links of unit u: at[u] to at[u + 1]
        self.counts = np.diff(np.stack([at_a, at_b, np.searchsorted(common, edge, "right"), self.at]), axis=1).astype(np.int32)
        self.form, self.form_at = self._forms(both, ids_a, end_a, at_a, ids_b, end_b, at_b, common)

    @staticmethod
    def _forms(both, ids_a, end_a, at_a, ids_b, end_b, at_b, common) -> tuple[bytes, np.ndarray]:
        """`a1,a2|b1;a3|b2,b3;` of all units (with the closing sign), and where each unit's begins."""
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        upto_a, upto_b = np.searchsorted(end_a, common, "right"), np.searchsorted(end_b, common, "right")
        place_a = np.arange(len(ids_a)) + np.concatenate([[0], upto_b])[group_a]
        place_b = np.arange(len(ids_b)) + upto_a[group_b]
        code = np.empty(len(ids_a) + len(ids_b), np.int64)
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        last_a[upto_a - 1] = last_b[upto_b - 1] = True
        code[place_a] = ids_a + last_a * len(both.a_bytes)
        code[place_b] = ids_b + last_b * len(both.b_bytes) + 2 * len(both.a_bytes)
        ends = np.concatenate([[0], np.cumsum(both.signed_size[code])])
        return b"".join(map(both.signed.__getitem__, code.tolist())), ends[at_a + at_b]


class SeenUnits:
    """The alignments of units that a worker has met, kept from block to block up to ``SEEN`` of them."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ok, self.counts = np.zeros(0, bool), np.zeros((4, 0), np.int32)
        self.pairs, self.at = np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.form, self.form_at = b"", np.zeros(1, np.int64)

    def look_up(self, words: pa.Array) -> "UnitsOfBlock":
        """The alignments of distinct ``words``, in their order; those not met before are aligned now."""
        index = pc.index_in(words, value_set=self.words)
        if index.null_count:
            if len(self.words) + index.null_count > SEEN:
                self.clear()
                index = pa.nulls(len(words), pa.int32())
            fresh = words.filter(index.is_null())
            found = AlignedUnits(fresh.to_pylist(), self.both)
            place = np.cumsum(index.is_null().to_numpy(zero_copy_only=False)) - 1 + len(self.words)
            index = np.where(index.is_null(), place, index.fill_null(0))
            self.words = pa.concat_arrays([self.words, fresh])
            self.ok, self.counts = np.append(self.ok, found.ok), np.append(self.counts, found.counts, axis=1)
            self.pairs, self.at = np.append(self.pairs, found.pairs), np.append(self.at, found.at[1:] + self.at[-1])
            self.form, self.form_at = self.form + found.form, np.append(self.form_at, found.form_at[1:] + self.form_at[-1])
        return UnitsOfBlock(self, np.asarray(index, np.int64))


class UnitsOfBlock:
    def __init__(self, seen: SeenUnits, index: np.ndarray):
        self.ok, self.counts = seen.ok[index], seen.counts[:, index]
        self.pairs = seen.pairs[_ragged(index, seen.at)]
        self.at = np.concatenate([[0], np.cumsum((seen.at[1:] - seen.at[:-1])[index])])
        form = seen.form
        self.form = [form[lo:hi] for lo, hi in zip(seen.form_at[index].tolist(), seen.form_at[index + 1].tolist(), strict=True)]


@lru_cache(maxsize=2)
def seen_units(file_a: str, file_b: bytes) -> SeenUnits:
    """What a worker process keeps from task to task: the encoders and the units met."""
    return SeenUnits(Tokenizers(file_a, file_b))


def _packed(**columns) -> bytes:
    table = pa.table(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(payload) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(payload)).read_all()


def _ragged(take: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places of the entries of the ragged rows ``take``, in order; row r has the places at[r] to at[r + 1]."""
    size = at[take + 1] - at[take]
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at[take] - (ends - size), size)


def _row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros((*values.shape[:-1], values.shape[-1] + 1), np.int64)
    np.cumsum(values, axis=-1, out=total[..., 1:])
    return total[..., at[1:]] - total[..., at[:-1]]


def _text_units(texts: pa.Array, signs: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct units, the unit sequences one after the other, where each text's begins)."""
    spaced = pc.binary_join_element_wise(*(x.cast(pa.large_string()) for x in (pa.scalar(" "), texts, pa.scalar(""))))
    _, at, data = spaced.buffers()
    at = np.frombuffer(at, np.int64)[spaced.offset: spaced.offset + len(spaced) + 1]
    start = unit_starts(np.frombuffer(data, np.uint8)[: at[-1]], at, signs)
    offsets = pa.array(np.append(start, at[-1]))
    coded = pc.dictionary_encode(pa.LargeStringArray.from_buffers(len(start), offsets.buffers()[1], data))
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.searchsorted(start, at)


def make_block(number: int, texts: pa.Array, times: np.ndarray, seen: SeenUnits) -> pa.RecordBatch:
    """Distinct texts with their multiplicities, aligned: measures, and what the counts of pairs are needed for."""
    words, units, at = _text_units(texts, seen.both.signs)
    aligned = seen.look_up(words)
    good = _row_sums((~aligned.ok).astype(np.int64)[units], at) == 0
    sums = np.stack([_row_sums(c[units], at) for c in aligned.counts]) * good
    pairs, place = np.unique(aligned.pairs, return_inverse=True)
    docs = _documents(units, at, good, times, place, aligned.at, len(pairs))
    form, sequence, edge, shas = aligned.form.__getitem__, units.tolist(), at.tolist(), []
    for lo, hi, ok in zip(edge[:-1], edge[1:], good.tolist(), strict=True):
        shas.append(hashlib.sha256(b"".join(map(form, sequence[lo:hi]))[:-1]).hexdigest() if ok else "")
    held = docs > 0                                         # pairs of texts that come out whole
    links = np.where(held, np.cumsum(held) - 1, -1)[place]
    digests = [hashlib.sha256(x.as_buffer()).digest() for x in texts]
    rows = _packed(digest=pa.array(digests, pa.binary()), good=good, sha=pa.array(shas, pa.string()), n_units=np.diff(at),
                   **{name: pa.array(sums[i], pa.int64()) for i, name in enumerate(MEASURES[:4])})
    lists = _packed(kind=pa.array(["units", "links", "links_at", "pairs", "docs"]), values=pa.array(
        [units, links, aligned.at, pairs[held], docs[held]], pa.list_(pa.int64())))
    return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "texts": pa.array([rows], pa.binary()),
                                       "units": pa.array([lists], pa.binary())})


def _documents(units, at, good, times, place, links_at, n_pairs) -> np.ndarray:
    """For each pair, the documents that hold it: the multiplicities of the good texts, each text once."""
    docs = np.zeros(n_pairs, np.int64)
    text = np.repeat(np.arange(len(good)), np.diff(at))
    n_units = max(len(links_at) - 1, 1)
    held = np.sort((text * n_units + units)[good[text]])
    held = held[np.diff(held, prepend=-1) != 0]              # a text has each unit once
    text, units = held // n_units, held % n_units
    upto = np.cumsum(links_at[units + 1] - links_at[units])
    lo = 0
    while lo < len(held):                                    # in steps that bound the links written out at a time
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + C.SLICE_BYTES, "right")))
        hi = int(np.searchsorted(text, text[hi - 1], "right"))
        step = _ragged(units[lo:hi], links_at)
        of = np.repeat(text[lo:hi], (links_at[units + 1] - links_at[units])[lo:hi])
        seen = np.sort(of * n_pairs + place[step])
        seen = seen[np.diff(seen, prepend=-1) != 0]
        docs += np.bincount(seen % n_pairs, times[seen // n_pairs], n_pairs).astype(np.int64)
        lo = hi
    return docs


def _lists(payload) -> dict[str, np.ndarray]:
    table = _unpacked(payload)
    return {k: v.values.to_numpy(zero_copy_only=False)
            for k, v in zip(table.column("kind").to_pylist(), table.column("values"), strict=True)}


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    ``path_a`` is a byte-level BPE file, ``path_b`` a piece model that adds the
    space; the driver reads both.
    """
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))     # bounded by the vocabulary files
    text = F.col(f"`{text_col}`")
    once = (docs.where(text.isNotNull() & (text != "")).select(text.alias("text"))
            .groupBy("text").agg(F.count(F.lit(1)).alias("times"))
            # a fixed order: a task that runs again makes the same blocks
            .sortWithinPartitions(F.xxhash64("text"), "text"))

    def blocks(batches):
        seen = seen_units(*files.value)
        first, n, held, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in batches:
            for lo, _, edge in C.text_slices(batch.column(0), BLOCK_BYTES // 8):
                held.append(batch.slice(lo, len(edge) - 1))
                size += int(edge[-1])
                if size >= BLOCK_BYTES:
                    yield finished(first | n, held, seen)
                    n, held, size = n + 1, [], 0
        if held:
            yield finished(first | n, held, seen)

    def finished(number, held, seen):
        table = pa.Table.from_batches(held).combine_chunks()
        return make_block(number, table.column(0).chunk(0), table.column(1).to_numpy(), seen)

    def pairs_of(key, table):
        found = _lists(table.column("units")[0].as_py())
        return pa.table({"block": pa.array(np.full(len(found["pairs"]), key[0].as_py())), "pair": found["pairs"], "docs": found["docs"]})

    def last(left, right):
        texts, found = _unpacked(left.column("texts")[0].as_py()), _lists(left.column("units")[0].as_py())
        order = np.argsort(right.column("pair").to_numpy())
        if not np.array_equal(right.column("pair").to_numpy()[order], found["pairs"]):
            raise RuntimeError("the counts that came back are of another block")
        values = np.stack([right.column("best").to_numpy()[order].astype(np.int64), right.column("n").to_numpy()[order]])
        values = np.concatenate([values, np.zeros((2, 1), np.int64)], axis=1)       # -1: a link that counts nowhere
        of_unit = _row_sums(values[:, found["links"]], found["links_at"])
        at = np.concatenate([[0], np.cumsum(texts.column("n_units").to_numpy())])
        sums = _row_sums(of_unit[:, found["units"]], at) * texts.column("good").to_numpy(zero_copy_only=False)
        return pa.table({"digest": texts.column("digest"), **{m: texts.column(m) for m in MEASURES[:4]},
                         "n_best": sums[0], "count_sum": sums[1], "groups_sha256": texts.column("sha")})

    by_block = once.mapInArrow(blocks, _BLOCKS).groupBy("block")
    asked = by_block.applyInArrow(pairs_of, "block long, pair long, docs long")
    counted = asked.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", B_BITS))
    top = counted.groupBy("a").agg(F.max("n").alias("top"))          # a row for each A id at most
    known = counted.join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    replies = asked.join(known, "pair").select("block", "pair", "n", "best")
    measured = by_block.cogroup(replies.groupBy("block")).applyInArrow(
        last, "digest binary, " + ", ".join(f"{m} long" for m in MEASURES) + ", groups_sha256 string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.unhex(F.sha2(F.encode(text, "utf-8"), 256)).alias("digest"))
    return rows.join(measured, "digest", "left").select(
        "doc_id", *(F.coalesce(m, F.lit(0).cast("long")).alias(m) for m in MEASURES),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return alignment(C.read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                     public_tokenizers.path("piece_bpe_32k.model"))
