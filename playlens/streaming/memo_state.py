"""TTL memo, streaming form: keyed state with ``applyInPandasWithState``.

State per key is two numbers – the time the value was computed and the value
– so it stays small whatever the key's volume.  Expiry is checked lazily on
each event's own timestamp (age ``< ttl`` reuses, ``>= ttl`` recomputes);
state is never refreshed on read.  Within a micro-batch a key's events are
processed in ``(t, id)`` order; the batch size is bounded by the source's
trigger limits (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .. import constants as C

OUTPUT_SCHEMA = "k int, t long, event_id long, score double, memo_at long, memo_value double"
STATE_SCHEMA = "at long, value double"


def _memo_fn(ttl: int, evict: bool = False):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if evict and state.hasTimedOut:
            state.remove()          # the stored value can never be reused
            return
        at, value = (state.get if state.exists else (None, None))
        batch = pd.concat(list(pdfs), ignore_index=True).sort_values(["t", "event_id"])
        memo_at, memo_val = [], []
        for t, v in zip(batch["t"].to_numpy(), batch["score"].to_numpy()):
            if at is None or t - at >= ttl:
                at, value = int(t), float(v)
            memo_at.append(at)
            memo_val.append(value)
        state.update((at, value))
        if evict:
            state.setTimeoutTimestamp(max((at + ttl) * 1000,
                                          state.getCurrentWatermarkMs() + 1))
        out = batch.assign(memo_at=memo_at, memo_value=memo_val)
        yield out[["k", "t", "event_id", "score", "memo_at", "memo_value"]]

    return fn


def stream_memo(events: DataFrame, ttl: int = C.MEMO_TTL_SECONDS,
                watermark: str | None = None) -> DataFrame:
    """``events(k int, t long, event_id long, score double)`` stream ->
    per-event memo (append mode).  With ``watermark`` (a delay on the event
    time ``t``) a key's state is evicted once the watermark passes
    ``at + ttl``; as with any watermark, events older than it are dropped as
    late data, so the delay should cover the source's disorder."""
    if watermark is None:
        return events.groupBy("k").applyInPandasWithState(
            _memo_fn(ttl), OUTPUT_SCHEMA, STATE_SCHEMA, "append",
            GroupStateTimeout.NoTimeout)
    timed = events.withColumn("_ts", F.timestamp_seconds("t")).withWatermark("_ts", watermark)
    return timed.groupBy("k").applyInPandasWithState(
        lambda key, pdfs, state: _memo_fn(ttl, True)(
            key, (p.drop(columns=["_ts"]) for p in pdfs), state),
        OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)


#: Rows without a memo key are dealt over so many groups that keep no state.
UNKEYED_PARTS = 256


def _anchor_fn(ttl: int, t_col: str, order_col: str, evict: bool):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if evict and state.hasTimedOut:
            # the watermark passed at + ttl: this value can never be reused
            state.remove()
            return
        if key[0] is None:          # not gated: nothing to memoise, piece by piece
            for pdf in pdfs:
                yield pdf.drop(columns=["_memo_part"]).assign(_memo_at=None, _memo_new=False)
            return
        batch = pd.concat(list(pdfs), ignore_index=True).drop(columns=["_memo_part"])
        batch = batch.sort_values([t_col, order_col], kind="stable").reset_index(drop=True)
        t = batch[t_col].to_numpy(dtype="int64")
        at = state.get[0] if state.exists else None
        # each row takes the value computed at the time of an anchor row, or of the state
        i = int(np.searchsorted(t, at + ttl)) if at is not None else 0
        anchor, new = np.full(len(t), -1 if at is None else at), np.zeros(len(t), bool)
        while i < len(t):
            end = max(i + 1, int(np.searchsorted(t, t[i] + ttl)))
            at = int(t[i])
            anchor[i:end], new[i] = at, True
            i = end
        state.update((at,))
        if evict:
            state.setTimeoutTimestamp(max((at + ttl) * 1000, state.getCurrentWatermarkMs() + 1))
        yield batch.assign(_memo_at=anchor, _memo_new=new)

    return fn


def with_anchors(games: DataFrame, key_col: str, t_col: str, order_col: str,
                 ttl: int = C.MEMO_TTL_SECONDS,
                 watermark: str | None = None, ts_col: str | None = None) -> DataFrame:
    """Streaming: ``_memo_at``, the time at which the value that a row takes was
    first computed for its memo key, while that value is younger than ``ttl``
    (seconds of ``t_col``), and ``_memo_new``, true on the row that computes it.
    ``(key, _memo_at)`` names a value.  Rows with a null key pass through, dealt
    over ``UNKEYED_PARTS`` groups that hold no state.

    With ``watermark`` (a delay such as ``"10 minutes"`` on the timestamp
    column ``ts_col``) a key's state is evicted once the watermark passes
    ``at + ttl``; without it, state is kept per key for the life of the query.
    Rows older than the watermark are dropped as late data, so the delay
    should cover the source's disorder.
    """
    evict = watermark is not None
    if evict:
        games = games.withWatermark(ts_col, watermark)
    timeout = GroupStateTimeout.EventTimeTimeout if evict else GroupStateTimeout.NoTimeout
    part = F.when(F.col(key_col).isNull(), F.pmod(F.xxhash64(order_col), F.lit(UNKEYED_PARTS)))
    schema = StructType([*games.schema.fields, StructField("_memo_at", LongType()), StructField("_memo_new", BooleanType())])
    return games.withColumn("_memo_part", part).groupBy(key_col, "_memo_part").applyInPandasWithState(
        _anchor_fn(ttl, t_col, order_col, evict), schema, "at long", "append", timeout)
