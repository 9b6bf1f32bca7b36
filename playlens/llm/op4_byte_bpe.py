"""Byte-level BPE encoding and decoding by ranks, on the distinct words of the corpus.

1. Blocks of documents list their distinct words (matches of the pattern) and
   write each text as word numbers, so a text is split once and not shuffled; the
   words meet at buckets of a hash, so each word of the corpus is encoded once.
2. Spark's higher-order functions fold ranked merges over each word's bytes
   (written in hexadecimal): the state is the cuts left between pieces with
   the ranks of merging there, and each step merges the leftmost pair of least
   rank. Ranks come from a literal map, kept as an array of small maps by a
   hash of the piece because a map is searched entry by entry.
3. The token ids go back to the blocks that asked; a text's ids are those of
   its words in order, and decoding concatenates the binary pieces of the ids.

A word above ``FOLD_BYTES`` bytes would take that many folding steps of that
length; those few are merged with a heap where the text is (the same merges).

Edge cases: a null or empty text has no ids; special strings are ordinary text;
repeated rows are encoded each; a null id passes through; an empty table gives
an empty result; other columns pass through ``encode_documents``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm import common as C
from playlens.llm.op1_token_counts import merge, splitter

#: Text bytes of a block.
CHUNK_BYTES = 16 << 20
FOLD_BYTES = 256
RANK_MAPS = 1 << 16
_NONE, _PLACE_BITS = (1 << 31) - 1, 10

_BLOCKS = "block long, docs binary, sizes binary, numbers binary, words binary"
_MESSAGES = "bucket int, block long, words binary, mark long"
_ANSWERS = "block long, bucket int, ids binary, mark long"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(word): int(n) for word, n in map(bytes.split, f)}


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks as one literal, an array of maps; Catalyst folds the parsing away."""
    maps: list[dict[str, int]] = [{} for _ in range(RANK_MAPS)]
    for word, n in ranks.items():
        piece = word.hex()
        maps[xxhash.xxh64_intdigest(piece.encode(), 42) % RANK_MAPS][piece] = n
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def fold_merges(word: Column, table: Column) -> Column:
    """Token ids of a word given in hexadecimal, as an array of ints.

    The state of the fold is one array: for each cut left in the word's bytes,
    the rank of merging across it and, in the low bits, its place. The least
    entry is the leftmost pair of least rank; merging drops that cut and ranks
    the cuts beside it anew.
    """
    n = (F.length(word) / 2).cast("int")

    def rank(start, end):
        piece = F.substr(word, 2 * start + 1, 2 * (end - start))
        # XXH64 is unsigned where the maps are built; RANK_MAPS divides 2**64, so both agree
        place = F.pmod(F.xxhash64(piece), F.lit(RANK_MAPS)).cast("int")
        return F.coalesce(F.try_element_at(F.get(table, place), piece), F.lit(_NONE))

    def entry(start, cut, end):
        return F.shiftleft(rank(start, end).cast("long"), _PLACE_BITS) + cut

    def place(cuts, i, otherwise):
        return F.coalesce(F.get(cuts, i).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int"), otherwise)

    def merged(cuts, least):
        def at(i):
            left, right = place(cuts, i - 1, F.lit(0)), place(cuts, i + 1, n)
            return F.transform(F.array_remove(cuts, least), lambda x, k: F.when(
                k == i - 1, entry(place(cuts, i - 2, F.lit(0)), left, right)).when(
                k == i, entry(left, right, place(cuts, i + 2, n))).otherwise(x))

        return _let((F.array_position(cuts, least) - 1).cast("int"), at)

    def step(cuts, _):
        return _let(F.array_min(cuts), lambda least: F.when(
            F.coalesce(least, F.lit(_NONE << _PLACE_BITS)) >= (_NONE << _PLACE_BITS), cuts).otherwise(merged(cuts, least)))

    every = F.transform(F.sequence(F.lit(1), n - 1), lambda i: entry(i - 1, i, i + 1))
    cuts = F.when(n > 1, F.aggregate(F.sequence(F.lit(1), n - 1), every, step)).otherwise(F.array().cast("array<bigint>"))
    return _let(cuts, lambda c: F.transform(
        F.sequence(F.lit(0), F.size(c)), lambda i: rank(place(c, i - 1, F.lit(0)), place(c, i, n))))


def _packed(table: pa.Table | pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    if isinstance(table, pa.Array):
        table = pa.table({"x": table})
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _table(payload) -> pa.Table:
    return pa.ipc.open_stream(payload.as_buffer()).read_all()


def _unpacked(payload) -> pa.Array:
    return _table(payload).column("x").combine_chunks()


class _Block:
    """The words of a block's texts as numbers, the commonest word first, and its documents without their texts.

    A slice of texts is split and numbered before the next one is read, so that a
    worker holds each distinct word of a slice once and four bytes for every word.
    """

    def __init__(self, find):
        self.find, self.docs, self.words, self.sizes, self.bytes = find, [], [], [], 0

    def add(self, batch: pa.RecordBatch, size: int) -> None:
        """Documents whose last column is the text; ``size`` are its bytes."""
        found = [pa.array(self.find(t.as_py()) if t.is_valid else [], pa.large_string())
                 for t in batch.column(batch.num_columns - 1)]
        self.sizes += map(len, found)
        self.words.append(pa.concat_arrays(found).dictionary_encode())
        # copied, as a slice would keep the texts beside it
        self.docs.append(batch.select(range(batch.num_columns - 1)).take(pa.array(np.arange(batch.num_rows))))
        self.bytes += size

    def finish(self, number: int) -> pa.RecordBatch:
        words = pa.chunked_array(self.words).unify_dictionaries()
        self.words, distinct = [], words.chunk(words.num_chunks - 1).dictionary
        index = np.concatenate([x.indices.to_numpy(zero_copy_only=False) for x in words.chunks])
        del words
        common = np.argsort(-np.bincount(index, minlength=len(distinct)), kind="stable")
        place = np.empty(len(common), np.uint32)
        place[common] = np.arange(len(common))
        numbers = place[index]
        # high and low halves apart: the high ones, mostly zero, take hardly any room
        numbers = pa.table({"low": (numbers & 0xFFFF).astype(np.uint16), "high": (numbers >> 16).astype(np.uint16)})
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()), "docs": pa.array([_packed(pa.Table.from_batches(self.docs))], pa.binary()),
            "sizes": pa.array([_packed(pa.array(self.sizes, pa.int64()))], pa.binary()),
            "numbers": pa.array([_packed(numbers)], pa.binary()),
            "words": pa.array([_packed(distinct.take(pa.array(common)))], pa.binary())})


def _by_bucket(words: list[str], n: int) -> tuple[dict[int, list[int]], list[int]]:
    """Numbers of the words of each bucket, in order, and of those too long to fold."""
    buckets: dict[int, list[int]] = {}
    long = []
    for k, w in enumerate(words):
        raw = w.encode()
        if len(raw) > FOLD_BYTES:
            long.append(k)
        else:
            buckets.setdefault(zlib.crc32(raw) % n, []).append(k)
    return buckets, long


def _mark(words) -> int:
    """Names the words that an answer is for."""
    return xxhash.xxh64_intdigest(words.as_buffer()) >> 1


def encode_documents(docs: DataFrame, path: str, text_col: str, finish, schema) -> DataFrame:
    """Rows made by ``finish(table, ids, decoded)`` from each block of documents.

    ``table`` has all columns but the text; ``ids`` has the token ids of each text
    as little-endian unsigned 32-bit integers; ``decoded`` the bytes that the ids
    stand for, put together from their pieces once for each distinct word.
    A block is made of neighbouring rows, so ``docs`` should be read from files or
    a checkpoint: if its rows came in another order when a lost block is made
    again, the answers would not be for its words, and the task fails.
    """
    spark = docs.sparkSession
    ranks = read_ranks(path)
    shared = spark.sparkContext.broadcast(ranks)               # bounded by the vocabulary file
    small = max(ranks.values(), default=0) < 1 << 16
    n = C.chunk_count(docs, text_col, CHUNK_BYTES)

    def blocks(batches):
        C.release_unused()
        first, k, find = TaskContext.get().partitionId() << 32, 0, splitter()
        held = _Block(find)
        for batch in batches:
            for lo, _, edge in C.text_slices(batch.column(batch.num_columns - 1)):
                held.add(batch.slice(lo, len(edge) - 1), int(edge[-1]))
                if held.bytes >= CHUNK_BYTES:
                    yield held.finish(first | k)
                    k, held = k + 1, _Block(find)
        if held.sizes:
            yield held.finish(first | k)

    def messages(key, table):
        C.release_unused()
        words = _unpacked(table.column("words")[0])
        buckets, _ = _by_bucket(words.to_pylist(), n)
        sent = [_packed(words.take(pa.array(x))) for x in buckets.values()]
        return pa.table({"bucket": pa.array(list(buckets), pa.int32()), "block": pa.array([key[0].as_py()] * len(sent), pa.int64()),
                         "words": pa.array(sent, pa.binary()), "mark": pa.array([_mark(table.column("words")[0])] * len(sent), pa.int64())})

    def distinct(key, table):
        C.release_unused()
        words = {w for x in table.column("words") for w in _unpacked(x).to_pylist()}
        return pa.table({"bucket": pa.array([key[0].as_py()] * len(words), pa.int32()),
                         "word": pa.array([w.encode().hex() for w in words], pa.string())})

    def answers(left, right):
        C.release_unused()
        known = dict(zip(right.column("raw").to_pylist(), range(right.num_rows), strict=True))
        ids = right.column("ids").combine_chunks().cast(pa.list_(pa.uint16() if small else pa.int32()))
        out = []
        for x in left.column("words"):
            places = [known[w.encode()] for w in _unpacked(x).to_pylist()]
            out.append(_packed(ids.take(pa.array(places, pa.int32()))))
        return pa.table({"block": left.column("block"), "bucket": left.column("bucket"), "ids": pa.array(out, pa.binary()),
                         "mark": left.column("mark")})

    def last(left, right):
        C.release_unused()
        words = _unpacked(left.column("words")[0]).to_pylist()
        buckets, long = _by_bucket(words, n)
        if {_mark(left.column("words")[0])} != {*right.column("mark").to_pylist()} and buckets:
            raise RuntimeError("the answers are for other words: the block was made again from rows in another order")
        coded = [b""] * len(words)
        for bucket, payload in zip(right.column("bucket").to_pylist(), right.column("ids"), strict=True):
            ids = _unpacked(payload)
            flat = ids.flatten().to_numpy().astype("<u4").tobytes()
            at = (4 * ids.offsets.to_numpy().astype(np.int64)).tolist()
            base = at[0] if at else 0
            for k, a, b in zip(buckets[bucket], at[:-1], at[1:], strict=True):
                coded[k] = flat[a - base: b - base]
        rank = shared.value
        for k in long:
            pieces = merge([bytes([b]) for b in words[k].encode()], lambda a, b: rank.get(a + b))
            coded[k] = np.array([rank[p] for p in pieces], "<u4").tobytes()
        pieces = [b""] * (max(rank.values(), default=-1) + 1)
        for word, i in rank.items():
            pieces[i] = word
        plain = [decode(x, pieces) for x in coded]
        halves = _table(left.column("numbers")[0])
        numbers = halves.column("low").to_numpy() | halves.column("high").to_numpy().astype(np.uint32) << 16
        ends = np.cumsum(_unpacked(left.column("sizes")[0]).to_numpy()).tolist()
        ids, decoded = [], []
        for lo, hi in zip([0, *ends[:-1]], ends, strict=True):
            row = numbers[lo:hi].tolist()
            ids.append(b"".join(map(coded.__getitem__, row)))
            decoded.append(b"".join(map(plain.__getitem__, row)))
        del coded, plain, words, numbers
        return finish(_table(left.column("docs")[0]), ids, decoded)

    text = F.col(f"`{text_col}`").alias("__text")
    by_block = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text_col], text).mapInArrow(blocks, _BLOCKS).groupBy("block")
    sent = by_block.applyInArrow(messages, _MESSAGES).groupBy("bucket")
    words = sent.applyInArrow(distinct, "bucket int, word string")
    coded = words.select("bucket", F.unhex("word").alias("raw"), _let(rank_literal(ranks), lambda t: fold_merges(F.col("word"), t)).alias("ids"))
    replies = sent.cogroup(coded.groupBy("bucket")).applyInArrow(answers, _ANSWERS)
    return by_block.cogroup(replies.groupBy("block")).applyInArrow(last, schema)


def decode(ids: bytes, pieces: list[bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _digest(table, ids, decoded):
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    return pa.table({"doc_id": table.column("doc_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                     "ids_sha256": pa.array(map(sha, ids), pa.string()),
                     "decoded_sha256": pa.array(map(sha, decoded), pa.string())})


def encoded_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return encode_documents(slim, path, "text", _digest,
                            "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _token_rows(table, ids, decoded):
    lists = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))
    return pa.table({"doc_id": table.column("doc_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                     "ids": lists, "decoded": pa.array([x.decode() for x in decoded], pa.string())})


def token_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: the ids themselves and the text made from them again."""
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return encode_documents(slim, path, "text", _token_rows, "doc_id long, n_tokens long, ids array<int>, decoded string")


def query(spark, sf_dir: str) -> DataFrame:
    return encoded_digests(C.read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))
