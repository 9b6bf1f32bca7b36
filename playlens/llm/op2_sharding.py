"""Shards of near equal bytes: the minimax contiguous partition of ordered groups.

Documents with equal text are one atomic group; groups are ordered by a 60-bit
hash of the text. The capacity is the least C for which greedy filling, group
after group, needs no more than ``shards`` shards; a binary search finds it and
the cuts are made there (law ``bytes``).

The driver never sees all groups. It searches over a few thousand *units*,
intervals of the hash order with their bytes. Greedy filling with units as atoms
never gets past the true cuts, filling with divisible units never falls short
of them; only units between the two can hold a cut, and only those are split
finer (one small aggregation each round) until each is a single group. Then the
search is exact.

Edge cases: a null text counts as empty (size 1) and equals other empty texts;
repeated rows and null ids are placed like any others; with fewer groups than
shards, or one group larger than a fair share, late shards may stay empty; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm import common as C

SHARDS = 16
#: Bits of the order, of the first units, and of each split.
KEY_BITS, FIRST_BITS, SPLIT_BITS = 60, 12, 8
#: Parts of a shard whose rows are numbered side by side.
SLOT_PARTS = 1024


def _fill(ends: list[int], capacity: int, shards: int, whole: list[bool] | None = None) -> list[int]:
    """Bytes at each cut of greedy filling; with ``whole`` given, other units are cut anywhere."""
    cuts, at = [], 0
    for _ in range(shards):
        goal = at + capacity
        n = bisect_right(ends, goal)
        at = goal if whole is not None and n < len(ends) and not whole[n] else ends[n - 1] if n else 0
        cuts.append(at)
    return cuts


def least_capacity(sizes: list[int], shards: int, whole: list[bool] | None = None) -> int:
    """The least capacity with which greedy filling places all within ``shards`` shards."""
    ends = list(accumulate(sizes))
    total = ends[-1] if ends else 0
    low, high = -(-total // shards), total
    while low < high:
        middle = (low + high) // 2
        if _fill(ends, middle, shards, whole)[-1] >= total:
            high = middle
        else:
            low = middle + 1
    return low


def _units(rows: DataFrame, bits: int, within: list[int] | None) -> list[tuple[int, int, bool]]:
    """(first key, bytes, whether it is one group) of each interval of 2**(KEY_BITS - bits) keys that has rows."""
    shift = KEY_BITS - bits
    if within is not None:
        rows = rows.where(F.shiftrightunsigned("key", shift + SPLIT_BITS).isin(within))
    found = rows.groupBy(F.shiftrightunsigned("key", shift).alias("unit")).agg(
        F.sum("size"), (F.min("key") == F.max("key"))).collect()
    return sorted((u << shift, int(size), one) for u, size, one in found)


def cut_keys(rows: DataFrame, shards: int) -> list[int]:
    """First keys of the shards after the first, from rows with ``key`` and ``size``."""
    bits = FIRST_BITS
    units = _units(rows, bits, None)
    while True:
        sizes, whole = [u[1] for u in units], [u[2] for u in units]
        ends = list(accumulate(sizes))
        high, low = least_capacity(sizes, shards), least_capacity(sizes, shards, whole)
        early, late = _fill(ends, low, shards), _fill(ends, high, shards, whole)
        open_units = set()
        for a, b in zip(early, late, strict=True):
            lo, hi = bisect_right(ends, a), bisect_right(ends, max(a, b - 1))
            open_units |= {n for n in range(lo, min(hi + 1, len(units))) if not whole[n] and ends[n] - sizes[n] < b}
        if not open_units or bits >= KEY_BITS:
            break
        parents = [units[n][0] >> (KEY_BITS - bits) for n in sorted(open_units)]
        bits += SPLIT_BITS
        kept = [u for n, u in enumerate(units) if n not in open_units]
        units = sorted(kept + _units(rows, bits, parents))
    cuts = _fill(ends, high, shards)
    return [units[bisect_right(ends, c)][0] for c in cuts if c < (ends[-1] if ends else 0)]


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    text = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "utf-8")
    rows = C.cut(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS).alias("key")))
    shard = F.lit(0)
    for key in cut_keys(rows, shards):
        shard = shard + (F.col("key") >= F.lit(key)).cast("int")
    placed = rows.withColumns({"shard": shard, "part": C.chunk_of(SLOT_PARTS, "doc_id", "key")})
    order = Window.partitionBy("shard", "part").orderBy(F.col("doc_id").asc_nulls_last(), "text_crc32")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # at most shards * SLOT_PARTS rows, whatever the input
    offsets = (placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
               .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    return (placed.withColumn("place", F.row_number().over(order) - 1)
            .join(F.broadcast(offsets), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("offset") + F.col("place")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def query(spark, sf_dir: str) -> DataFrame:
    return shard_documents(C.read_documents(spark, sf_dir))
