"""Exact per-group row numbers and top-k that stay balanced when one group
is huge.

``Window.partitionBy(key)`` puts every row of a key into one task; a key that
holds a third of the data would then be sorted by a single core.  Here each
key is split by a *bucket* column that never decreases along the ordering
(an hour of the timestamp, say).  Every ``(key, bucket)`` slice is numbered on
its own, in parallel; the global number adds the row counts of the same key
in the earlier buckets, which come from a small ``(key, bucket)`` count table
(one row per non-empty bucket of a key).  The result is exact and does not
depend on the physical partitioning, so AQE may re-plan freely and a task
retry recomputes the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(order):
    return [F.col(c) if isinstance(c, str) else c for c in order]


def row_number_by(df: DataFrame, keys: list[str], order: list, bucket: Column,
                  name: str = "rn", coarse: Column | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)``, split by
    ``bucket`` (must be non-decreasing in ``order`` within a key).

    ``coarse`` (optional, non-decreasing and constant within a bucket) adds a
    second level to the offsets: bucket counts are prefix-summed within their
    coarse slice, and coarse totals across slices.  Use it when a key has so
    many buckets that one key's bucket table should not sit in one task
    (e.g. the global numbering, ``keys=[]``)."""
    ocols = _cols(order)
    b = df.withColumn("_b", bucket)
    if coarse is not None:
        b = b.withColumn("_c", coarse)
    local = b.withColumn(
        "_lrn", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*ocols)))
    if coarse is None:
        counts = b.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(
            Window.unboundedPreceding, -1)
        offsets = counts.select(*keys, "_b",
                                F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    else:
        counts = b.groupBy(*keys, "_c", "_b").agg(F.count(F.lit(1)).alias("_n"))
        inner = Window.partitionBy(*keys, "_c").orderBy("_b").rowsBetween(
            Window.unboundedPreceding, -1)
        within = counts.select(*keys, "_c", "_b",
                               F.coalesce(F.sum("_n").over(inner), F.lit(0)).alias("_in"))
        totals = counts.groupBy(*keys, "_c").agg(F.sum("_n").alias("_t"))
        outer = Window.partitionBy(*keys).orderBy("_c").rowsBetween(
            Window.unboundedPreceding, -1)
        starts = totals.select(*keys, "_c",
                               F.coalesce(F.sum("_t").over(outer), F.lit(0)).alias("_start"))
        offsets = within.join(starts, [*keys, "_c"]).select(
            *keys, "_b", (F.col("_start") + F.col("_in")).alias("_off"))
    return (local.join(offsets, [*keys, "_b"])
            .withColumn(name, (F.col("_lrn") + F.col("_off")).cast("long"))
            .drop("_b", "_c", "_lrn", "_off"))


def top_k_per_group(df: DataFrame, keys: list[str], order: list, k: int,
                    name: str = "rn", salts: int = 64) -> DataFrame:
    """First ``k`` rows per group with their position 1..k.

    Two phases: rows are spread over ``salts`` sub-groups by a hash of the
    whole row, each sub-group keeps its own top ``k`` (parallel, bounded), and
    the final ranking sees at most ``k * salts`` candidates per group."""
    ocols = _cols(order)
    salt = F.abs(F.xxhash64(*df.columns)) % salts
    s = df.withColumn("_salt", salt)
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*ocols)
    cand = s.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w2 = Window.partitionBy(*keys).orderBy(*ocols)
    return (cand.withColumn(name, F.row_number().over(w2)).where(F.col(name) <= k)
            .drop("_salt", "_r1"))
