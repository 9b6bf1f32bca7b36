"""Importance resampling towards a target distribution, by hashed n-grams.

Arrow kernels do the text work: ``ascii_lower``, ``split_pattern_regex`` and
``list_flatten`` give the words of a slice of texts, ``dictionary_encode`` numbers
them. Shifted dictionary indices, encoded again, are the distinct pairs and
triples; the CRC of each distinct n-gram comes from those of its parts (a CRC is
linear: the head's is advanced by the tail's length), once for each slice.

1. Both corpora are counted into ``BUCKETS`` buckets: a task adds up its slices and
   sends one row for each bucket.
2. A bucket's gain is 1000 ln of the target's smoothed share over the corpus's.
   The ``BUCKETS`` gains (a bound that does not grow) go to every task.
3. Each feature's gain is taken and segments are added up: a document's weight.
   The features' buckets are written to the shared folder in between (two bytes a
   feature), so the texts are read and split once.
4. Score is weight plus noise from a hash of the id; the highest scores are numbered
   slice by slice of equal score, so no task sorts them all.

Edge cases: null and empty texts have no words, weight 0 and are never drawn;
neither are rows with a null id, which have no score and do not count among the
documents that the share is of. Repeated rows count each; equal scores go to the
smaller id, and repeats of one id in any order. A very long text makes a slice of
its own (about 100 bytes of memory a word). With an empty target, or an empty
table, the smoothing alone gives the gains. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import common as C
from playlens.operators.ranking import row_number_by

BUCKETS, LONGEST = 10_000, 3
LEAST_WORDS, DRAW_PERCENT, SEED = 20, 5, 42
#: What parts words: ASCII other than letters and digits.
PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Text bytes of a slice, the unit in which n-grams are told apart.
SLICE = 6 << 20
#: Words above it are summed one by one by the library.
LONG_WORD = 64


class Advance:
    """CRC registers moved on over zero bytes, so that crc(a + b) = advance(crc(a), len(b)) ^ crc(b).

    The step is linear over bits: one column of 32 images for each length, kept
    as four tables by byte; a length's tables are those of two shorter lengths joined.
    """

    def __init__(self):
        self.table = _crc_table()
        self.images: dict[int, np.ndarray] = {}
        self.tables: dict[int, np.ndarray] = {}

    def _images(self, n: int) -> np.ndarray:
        """Where each single bit goes after ``n`` zero bytes."""
        if n not in self.images:
            if n == 0:
                self.images[n] = np.uint32(1) << np.arange(32, dtype=np.uint32)
            elif n == 1:
                # crc32(byte, start) of the library, freed of its part that does not depend on the start
                still = zlib.crc32(b"\0", 0)
                self.images[n] = np.array([zlib.crc32(b"\0", 1 << i) ^ still for i in range(32)], np.uint32)
            else:
                half = self._images(n // 2)
                far = self._apply(self._by_byte(half), half)
                self.images[n] = self._apply(self._by_byte(self._images(1)), far) if n % 2 else far
        return self.images[n]

    @staticmethod
    def _by_byte(images: np.ndarray) -> np.ndarray:
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        return np.stack([np.bitwise_xor.reduce(np.where(bits, images[8 * k: 8 * k + 8], 0).astype(np.uint32), axis=1)
                         for k in range(4)])

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24]

    def __call__(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``crc`` after ``lengths`` zero bytes, entry by entry."""
        known, which = np.unique(lengths, return_inverse=True)
        for n in known.tolist():
            if n not in self.tables:
                if len(self.tables) > 4096:
                    self.tables.clear()
                    self.images.clear()
                self.tables[n] = self._by_byte(self._images(n))
        if not len(known):
            return crc
        flat = np.stack([self.tables[n] for n in known.tolist()]).reshape(-1)
        base = which.astype(np.int64) << 10
        out = flat[base + (crc & 255)]
        out ^= flat[base + 256 + ((crc >> 8) & 255)]
        out ^= flat[base + 512 + ((crc >> 16) & 255)]
        out ^= flat[base + 768 + (crc >> 24)]
        return out


def _crc_table() -> np.ndarray:
    """What a step over one byte adds, by the low byte of the register."""
    # the library's value with its first and last complement undone
    return np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)


def word_crcs(words: pa.Array, starts: tuple[bytes, ...], table: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """CRCs of all words after each of ``starts``, byte by byte over all words at once; and the words' lengths."""
    _, at, data = words.cast(pa.large_binary()).buffers()
    at = np.frombuffer(at, np.int64)[words.offset: words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    size = np.diff(at)
    order = np.argsort(-size, kind="stable")
    still = np.sort(size)
    out = []
    for start in starts:
        crc = np.full(len(words), zlib.crc32(start) ^ 0xFFFFFFFF, np.uint32)
        for i in range(min(int(size.max(initial=0)), LONG_WORD)):
            on = order[: len(still) - int(np.searchsorted(still, i, "right"))]
            on = on[size[on] <= LONG_WORD] if still[-1] > LONG_WORD else on
            crc[on] = table[(crc[on] ^ data[at[on] + i]) & 255] ^ (crc[on] >> 8)
        crc ^= np.uint32(0xFFFFFFFF)
        for n in np.flatnonzero(size > LONG_WORD).tolist():
            crc[n] = zlib.crc32(data[at[n]: at[n + 1]], zlib.crc32(start))
        out.append(crc)
    return out, size


def _encoded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = pc.dictionary_encode(values)
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def _joined(head: np.ndarray, n_tails: int, tail: np.ndarray, head_crc: np.ndarray, tail_crc: np.ndarray,
            tail_bytes: np.ndarray, advance: Advance) -> tuple[np.ndarray, np.ndarray]:
    """(index of each n-gram, CRC of each distinct one) for heads followed by a space and a tail."""
    at, pairs = _encoded(pa.array(head.astype(np.int64) * max(n_tails, 1) + tail))
    pairs = pairs.to_numpy()
    first, second = pairs // max(n_tails, 1), pairs % max(n_tails, 1)
    return at, advance(head_crc[first], tail_bytes[second] + 1) ^ tail_crc[second]


def ngrams(texts: pa.Array, advance: Advance, longest: int = LONGEST):
    """(n, row of each n-gram, its index, CRC by index) for n = 1, 2, ...; rows of one n are in order."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts.fill_null("")), PARTS)
    words, row = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(words, "")                              # what lies before a leading or after a trailing break
    index, known = _encoded(words.filter(real))
    row = row.filter(real).to_numpy(zero_copy_only=False)
    (crc, spaced), size = word_crcs(known, (b"", b" "), advance.table)
    yield 1, row, index, crc
    head, head_crc = index, crc
    for n in range(2, longest + 1):
        # entry i of ``head`` is the (n-1)-gram that begins at word i, where it lies within its row
        whole = np.flatnonzero(row[n - 1:] == row[: len(row) - n + 1]) if len(row) >= n else np.zeros(0, np.int64)
        at, found = _joined(head[whole], len(known), index[whole + n - 1], head_crc, spaced, size, advance)
        yield n, row[whole], at, found
        head = np.zeros(len(row), np.int64)
        head[whole] = at
        head_crc = found


def _slices(column: pa.Array):
    for first, _, at in C.text_slices(column, SLICE):
        yield first, column.slice(first, len(at) - 1)


def features(docs: DataFrame, id_col: str | None, text_col: str, buckets: int) -> DataFrame:
    """A row for each slice of texts: the ids, words and features of each text, and the features' buckets in order."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches):
        advance = Advance()
        for batch in batches:
            for first, texts in _slices(batch.column(1)):
                grams = [(row, (crc % buckets).astype(kind).take(index)) for _, row, index, crc in ngrams(texts, advance)]
                rows = np.arange(len(texts) + 1)
                n_words = np.diff(np.searchsorted(grams[0][0], rows))
                row = np.concatenate([row for row, _ in grams])
                order = np.argsort(row, kind="stable")
                yield pa.RecordBatch.from_pydict({
                    "ids": pa.array([batch.column(0).slice(first, len(texts))], pa.list_(pa.int64())),
                    "n_words": pa.array([n_words], pa.list_(pa.int64())),
                    "n_features": pa.array([np.bincount(row, minlength=len(texts))], pa.list_(pa.int64())),
                    "buckets": pa.array([np.concatenate([b for _, b in grams])[order].tobytes()], pa.binary())})

    ids = F.col(f"`{id_col}`").cast("long") if id_col else F.lit(None).cast("long")
    return docs.select(ids.alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "ids array<long>, n_words array<long>, n_features array<long>, buckets binary")


def bucket_counts(made: DataFrame, buckets: int) -> list[int]:
    """How many features fall into each bucket; ``buckets`` numbers reach the driver."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), kind), minlength=buckets)
        yield pa.RecordBatch.from_pydict({"bucket": np.arange(buckets, dtype=np.int32), "n": total})

    found = made.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect()
    counts = [0] * buckets
    for bucket, n in found:
        counts[bucket] = n
    return counts


def gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each of the B buckets, in doubles."""
    many, few, b = float(sum(source)), float(sum(target)), len(source)
    return [math.floor(1000 * math.log((t + 1.0) * (many + b) / ((s + 1.0) * (few + b))))
            for s, t in zip(source, target, strict=True)]


def weights(made: DataFrame, gain: list[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every text of the slices."""
    shared = made.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))    # as long as there are buckets
    names, kind = ["doc_id", "n_words", "n_features", "weight"], np.uint16 if len(gain) <= 1 << 16 else np.uint32

    def run(batches):
        gain = shared.value
        for batch in batches:
            for ids, n_words, n_features, buckets in zip(*batch.columns, strict=True):
                size = n_features.values.to_numpy()
                total = np.concatenate([[0], np.cumsum(gain.take(np.frombuffer(buckets.as_buffer(), kind)))])
                ends = np.cumsum(size)
                yield pa.RecordBatch.from_arrays([ids.values, n_words.values, n_features.values,
                                                  pa.array(total[ends] - total[ends - size])], names=names)

    return made.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = DRAW_PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; rank is 1, 2, ... for those drawn, else null."""
    made = C.cut(features(docs, id_col, text_col, buckets))
    gain = gains(bucket_counts(made, buckets), bucket_counts(features(target, None, target_col, buckets), buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(uniform))).cast("long")
    rows = C.cut(weights(made, gain).withColumn("score", F.col("weight") + noise))
    may = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    draws = rows.where(may).count() * percent // 100
    numbered = row_number_by(rows.where(may), [], [F.col("score").desc(), F.col("doc_id")], -F.col("score"), "rank",
                             coarse=F.floor(-F.col("score") / 1024))
    drawn = F.when(F.col("rank") <= draws, F.col("rank")).alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return numbered.select(*columns, drawn).union(rows.where(~may).select(*columns, F.lit(None).cast("long")))


def query(spark, sf_dir: str) -> DataFrame:
    return resample(C.read_documents(spark, sf_dir), C.read_documents(spark, sf_dir, "benchmark"))
