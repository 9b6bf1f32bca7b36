"""TTL memo, batch form: exact, distributed, no group held by one task.

Semantics (per key, events in ``(t, id)`` order): the first event computes a
value and stores it with its time ``at``; later events reuse the stored value
while ``t - at < ttl``; the first event with ``t - at >= ttl`` recomputes and
becomes the new anchor.  Anchors are therefore the path that starts at a
key's first event and follows ``nxt(e)`` = first event with ``t >= t_e + ttl``.

Plan, all DataFrame joins/windows over bounded partitions:

1. ``nxt`` for every event by an as-of lookup: probes at ``t + ttl`` meet the
   events inside ``(key, slice)`` partitions (``slice`` = ``split_seconds``
   wide), falling back to the first event of the next non-empty slice from
   a per-key slice table (its size grows with the time span, not the rows).
2. Anchors by pointer doubling: ``P := P + J_i(P)``, ``J_{i+1} := J_i o J_i``,
   ``log2(anchors per key)`` rounds of equi-joins on the unique event id.
   Each round is checkpointed to the shared checkpoint folder, which cuts
   the lineage and survives executor loss.
3. Every event takes the latest anchor at or before it; anchors are at least
   ``ttl`` apart, so it lies in the event's own ``ttl`` bucket or the one
   before: an equi-join on ``(key, bucket)`` with at most two candidates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..session import shared_dir


def _ckpt(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession, "memo")  # sets the checkpoint dir if unset
    return df.checkpoint(eager=True)


def next_after(ev: DataFrame, ttl: int, split_seconds: int) -> DataFrame:
    """``(id, nxt_id)``: first event of the same key at or after ``t + ttl``."""
    w = split_seconds
    events = ev.select("k", "t", "id", F.lit(1).alias("kind"),
                       F.col("id").alias("eid"), F.lit(None).cast("long").alias("src"))
    probes = ev.select("k", (F.col("t") + ttl).alias("t"), F.lit(None).cast("long").alias("id"),
                       F.lit(0).alias("kind"), F.lit(None).cast("long").alias("eid"),
                       F.col("id").alias("src"))
    rows = events.unionByName(probes).withColumn("s", F.floor(F.col("t") / w))
    # "first event at or after me" as a running frame in reverse order: Spark
    # computes running frames incrementally, while a frame that ends at
    # "unbounded following" is re-aggregated for every row.
    back = [F.col("t").desc(), F.col("kind").desc(), F.col("id").desc()]
    ahead = Window.partitionBy("k", "s").orderBy(*back).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    within = rows.withColumn("cand", F.last("eid", ignorenulls=True).over(ahead))
    # per-key slice table: first event of each slice (null for probe-only slices)
    slices = rows.groupBy("k", "s").agg(
        F.min_by("eid", F.when(F.col("kind") == 1, F.struct("t", "id"))).alias("first_eid"))
    later = Window.partitionBy("k").orderBy(F.col("s").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    slices = slices.select("k", "s", F.last("first_eid", ignorenulls=True).over(later)
                           .alias("next_first"))
    p = within.where(F.col("kind") == 0).join(slices, ["k", "s"], "left")
    return p.select(F.col("src").alias("id"),
                    F.coalesce("cand", "next_first").alias("nxt"))


def anchors(ev: DataFrame, nxt: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Ids on the ``nxt`` path from each key's first event (pointer doubling).

    Both the path and the jump table are checkpointed every round: each is
    read twice by the next round, so an uncut lineage would double the plan
    per round."""
    first = ev.groupBy("k").agg(F.min(F.struct("t", "id")).alias("f")) \
        .select(F.col("f.id").alias("id"))
    path = _ckpt(first)
    size = path.count()
    jump = _ckpt(nxt.where(F.col("nxt").isNotNull()).select("id", F.col("nxt").alias("to")))
    for _ in range(max_rounds):
        step = path.join(jump, "id").select(F.col("to").alias("id"))
        grown = _ckpt(path.unionByName(step).distinct())
        grown_size = grown.count()
        if grown_size == size:
            return grown
        path, size = grown, grown_size
        j2 = jump.alias("a").join(jump.alias("b"), F.col("a.to") == F.col("b.id")) \
            .select(F.col("a.id").alias("id"), F.col("b.to").alias("to"))
        jump = _ckpt(j2)
    raise RuntimeError("anchor path did not converge")


def ttl_memo(events: DataFrame, key: str, t: str, id_col: str, value: str,
             ttl: int = C.MEMO_TTL_SECONDS, split_seconds: int = 60) -> DataFrame:
    """Per event: the memoised value and the time it was computed.

    ``t`` are whole epoch seconds, ``id_col`` is unique.  Returns the input
    columns plus ``memo_at`` and ``memo_value``.
    """
    ev = events.select(F.col(key).alias("k"), F.col(t).cast("long").alias("t"),
                       F.col(id_col).cast("long").alias("id"), F.col(value).alias("v"))
    ev = _ckpt(ev)
    nxt = _ckpt(next_after(ev, ttl, split_seconds))
    a = anchors(ev, nxt)
    anch = ev.join(a, "id").select(
        "k", F.col("t").alias("at"), F.col("id").alias("aid"), F.col("v").alias("memo_value"),
        F.floor(F.col("t") / ttl).alias("b"))
    cands = anch.unionByName(anch.withColumn("b", F.col("b") + 1))
    e = ev.withColumn("b", F.floor(F.col("t") / ttl))
    j = e.join(cands, ["k", "b"]).where(
        (F.col("at") < F.col("t")) | ((F.col("at") == F.col("t")) & (F.col("aid") <= F.col("id"))))
    best = j.groupBy("id").agg(F.max_by(F.struct("at", "memo_value"), F.struct("at", "aid"))
                               .alias("m"))
    out = ev.join(best, "id").select(
        F.col("k").alias(key), F.col("t").alias(t), F.col("id").alias(id_col),
        F.col("v").alias(value), F.col("m.at").alias("memo_at"),
        F.col("m.memo_value").alias("memo_value"))
    return out
