"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that parts words (a fixed value of the contracts).
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Text bytes that one numpy step works on at a time; bounds a task's memory.
SLICE_BYTES = 2 << 20
#: Stands for a missing doc_id where ids are compared: later than every real id.
NO_ID = np.iinfo(np.int64).max


def read_documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names; a local one only on a local master."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="playlens-llm-")
    sc.setCheckpointDir(base)


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, with their lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release_unused() -> None:
    """Freed memory goes back to the system: Python workers live on from group to group and stage to stage.

    Arrow's own pool holds its buffers, the system's those of numpy and the strings.
    """
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def chunk_count(df: DataFrame, text: str, chunk_bytes: int) -> int:
    """How many chunks of about ``chunk_bytes`` the texts make (one pass over their lengths)."""
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-int(total) // chunk_bytes))


def chunk_of(n: int, *cols: str | Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**i (or its inverse's) for i < n, modulo 2**64."""
    base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.ones(size, np.uint64)
        have[1:] = np.uint64(base)
        np.multiply.accumulate(have, out=have)
        _POWERS[base] = have
    return have[:n]


class RangeHash:
    """64-bit hashes of any ranges of a sequence, from prefix sums of a polynomial."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(n), out=self.sums[1:])
        self.back = powers(n + 1, inverse=True)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all ranges of one width, by their starts."""
        n = max(0, len(self.sums) - width)
        return mix((self.sums[width: width + n] - self.sums[:n]) * self.back[:n])


#: One random 64-bit value per byte, from a fixed seed: all tasks hash alike.
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows of about ``limit`` bytes together.

    A null is an empty text. A text longer than ``limit`` makes a slice of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield row, data[at[row]: at[end]], at[row: end + 1] - at[row]
        row = end


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True


def word_spans(data: np.ndarray, at: np.ndarray, breaks: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross rows. ``breaks`` tells which bytes part words."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~breaks[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < len(data)]
    start[heads] = inside[heads]
    start = np.flatnonzero(start)
    last = inside[:-1] & ~inside[1:]
    tails = at[1:][at[1:] > 0] - 1
    last[tails] = inside[tails]
    end = np.flatnonzero(last) + 1
    row = np.searchsorted(at, start, "right") - 1
    return start, end, row


#: Bytes that part words where punctuation does too: all ASCII but letters and digits.
PUNCTUATED = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: A-Z as a-z, other bytes as they are.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return RangeHash(BYTE_VALUES[data])(start, end)


def ids_of(column) -> np.ndarray:
    """Integer ids as int64, a null as NO_ID."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def order_by(*keys: np.ndarray) -> np.ndarray:
    """The order by several keys, the first one first; rows equal in all are in any order.

    Each key sorts only what those before it leave equal."""
    order = np.argsort(keys[0])
    first = keys[0][order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = first[1:] != first[:-1]
    for k in keys[1:]:
        live = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
        if not len(live):
            break
        at = order[live]
        values = k[at]
        by = np.argsort(values)
        values = values[by]
        rank = np.zeros(len(at), np.int64)
        rank[by[1:]] = np.cumsum(values[1:] != values[:-1])
        key = np.cumsum(fresh[live]) * len(at) + rank
        by = np.argsort(key)
        order[live], key = at[by], key[by]
        fresh[live[1:]] |= key[1:] != key[:-1]
    return order


def least_by(keys: tuple[np.ndarray, ...], *values: np.ndarray) -> np.ndarray:
    """Indexes of one row for each distinct key tuple: that of the least values."""
    order = order_by(*keys, *values, np.arange(len(keys[0])))
    if not len(order):
        return order
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order[new]


# ---- rows packed into compressed blocks, and arrays sent between blocks and buckets ----

PACKED = "chunk int, payload binary"


def pack(df: DataFrame, n: int, key: list[str]) -> DataFrame:
    """(chunk, payload): the rows as compressed Arrow blocks, dealt over ``n`` chunks by a hash of ``key``.

    A shuffle by chunk then moves about half the bytes that the rows themselves
    would take, in few large records. A chunk is a unit of work, not a partition.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]

    def blocks(batches):
        options = pa.ipc.IpcWriteOptions(use_threads=False, compression=pa.Codec("zstd", compression_level=5))
        for batch in batches:
            chunk = batch.column(0).to_numpy()
            table = pa.Table.from_batches([batch.select(list(range(1, batch.num_columns)))])
            order = np.argsort(chunk, kind="stable")
            edges = np.flatnonzero(np.diff(chunk[order], prepend=-1, append=-1))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=options) as out:
                    out.write_table(table.take(pa.array(order[lo:hi])))
                yield pa.RecordBatch.from_pydict(
                    {"chunk": pa.array([chunk[order[lo]]], pa.int32()),
                     "payload": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    dealt = df.select(chunk_of(n, *key).alias("__chunk"), *columns)
    return dealt.mapInArrow(blocks, PACKED)


def unpack(payloads) -> Iterator[pa.Table]:
    release_unused()
    options = pa.ipc.IpcReadOptions(use_threads=False)       # each core has a worker already
    for block in payloads:
        yield pa.ipc.open_stream(block.as_buffer(), options=options).read_all()


def scatter(chunk: int, key: np.ndarray, n: int, **arrays: np.ndarray) -> pa.Table:
    """One row for each bucket (key modulo ``n``) that has entries: bucket, chunk, the arrays as bytes."""
    bucket = (key % np.uint64(n)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    spans = list(zip(edges[:-1], edges[1:], strict=True))
    out = {"bucket": pa.array(bucket[order][edges[:-1]], pa.int32()),
           "chunk": pa.array(np.full(len(spans), chunk, np.int32))}
    for name, values in arrays.items():
        values = values[order]
        out[name] = pa.array([values[lo:hi].tobytes() for lo, hi in spans], pa.binary())
    return pa.table(out)


def gather(table: pa.Table, **kinds) -> tuple[np.ndarray, ...]:
    """The arrays of all rows one after the other, and last the row that each entry came from."""
    parts = {name: [np.frombuffer(x.as_buffer(), kind) if x.is_valid else np.zeros(0, kind)
                    for x in table.column(name)] for name, kind in kinds.items()}
    out = tuple(np.concatenate([*p, np.zeros(0, kinds[name])]).astype(kinds[name], copy=False)
                for name, p in parts.items())
    first = next(iter(parts.values()))
    return (*out, np.repeat(np.arange(len(first)), [len(x) for x in first]))


def answer(rows: pa.Table, row: np.ndarray, keep: np.ndarray, **arrays: np.ndarray) -> pa.Table:
    """Kept entries sent back to the chunk that each one's row came from."""
    chunk = rows.column("chunk").to_numpy()[row[keep]]
    order = np.argsort(chunk, kind="stable")
    edges = np.flatnonzero(np.diff(chunk[order], prepend=-1, append=-1))
    spans = list(zip(edges[:-1], edges[1:], strict=True))
    out = {"chunk": pa.array(chunk[order][edges[:-1]], pa.int32())}
    for name, values in arrays.items():
        values = values[keep][order]
        out[name] = pa.array([values[lo:hi].tobytes() for lo, hi in spans], pa.binary())
    return pa.table(out)


def groups(*sorted_keys: np.ndarray) -> np.ndarray:
    """The group number of each entry, of keys sorted together."""
    if not len(sorted_keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(sorted_keys[0]), bool)
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def lookup(keys: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each key lies in ``sorted_keys``, whether it is there)."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def anchors(order: np.ndarray, valid: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing: (anchor, first window, last window) of each run of windows with one anchor.

    ``order[i]`` ranks the seed at i, ``valid[i]`` says whether a window starts
    there; its anchor is the rightmost least seed of ``order[i : i + span]``,
    which depends on the window's content alone.
    """
    start = np.flatnonzero(valid)
    if not len(start):
        return start, start, start
    # rank in the high half, place (later is less) in the low half: one minimum gives both
    low = np.uint64(0xFFFFFFFF)
    best = (order & ~low) | (low - np.arange(len(order), dtype=np.uint64))
    reach, other = 1, np.empty_like(best)
    while reach < span:                      # windows double, then overlap to the exact span
        step = min(reach, span - reach)
        np.minimum(best[:-step], best[step:], out=other[:-step])
        other[-step:] = best[-step:]
        best, other = other, best
        reach += step
    at = (low - (best[start] & low)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    return at[head], start[head], start[np.append(head[1:], len(start)) - 1]


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window of ``width`` that begins at one of ``starts``."""
    change = np.bincount(starts, minlength=n + 1)
    change -= np.bincount(starts + width, minlength=n + 1)
    return np.cumsum(change[:-1]) > 0


def within(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, window) of every window first[r]..last[r] of every run r."""
    length = last - first + 1
    run = np.repeat(np.arange(len(first)), length)
    step = np.arange(len(run)) - np.repeat(np.cumsum(length) - length, length)
    return run, first[run] + step
