"""Structured Streaming enrichment: envelope stream -> documents sink.

``foreachBatch`` runs the batch enrichment plan on each micro-batch and
writes it with dynamic partition overwrite keyed by ``batch_id``.  With the
mandatory checkpoint location, a batch re-run after a failure rewrites its
own partition, so the sink holds each batch exactly once.  Partitions also
carry the stream's id, which lives in its checkpoint: a new checkpoint on the
same sink numbers batches from 0 again and must not replace earlier documents.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import constants as C
from ..functions import scores as S
from ..functions.sentiment import memo_key
from ..operators import enrich
from ..operators.ml import ModelRegistry, predict_all
from ..operators.sentiment import sentiment_gate, with_community_sentiment
from ..plans.enrichment import enrich_documents
from ..sinks.documents import document, write_documents
from ..sinks.snapshots import Snapshots
from ..sources.stream import decode_ok, decoded, parse
from .memo_state import with_anchors

#: ``posts_as_of``: the month of posts ends at each message's own envelope time.
ENVELOPE_TIME = "envelope"
#: A source table, or a function that reads it anew for each micro-batch.
Source = DataFrame | Callable[[], DataFrame]
SENTIMENT_COLS = ["community_sentiment_score", "community_sentiment_label",
                  "community_data_volume", "sentiment_source"]
MEMO_VALUES = ("_memo_key string, _memo_at long, community_sentiment_score double,"
               " community_sentiment_label string, community_data_volume int,"
               " sentiment_source string")
#: Values are kept for so many TTLs behind the latest message; a row later than that computes its value anew.
MEMO_KEPT_TTLS = 2


def _read(source: Source) -> DataFrame:
    return source if isinstance(source, DataFrame) else source()


def _window_end(games: DataFrame, posts_as_of: str | None) -> tuple[DataFrame, dict]:
    """The rows, and where their month of posts ends: at one instant, or at each row's own time."""
    if posts_as_of != ENVELOPE_TIME:
        return games, {"posts_as_of": posts_as_of}
    return games.withColumn("_until", F.to_timestamp("timestamp")), {"posts_until": "_until"}


def _load_id(batch_df: DataFrame) -> str:
    """Id of the running stream (kept in its checkpoint, so it survives restarts)."""
    return batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "0"


def batch_writer(posts: Source, reviews: Source, sink_path: str,
                 registry: ModelRegistry | None = None,
                 as_of_fn: Callable[[int], int] | None = None,
                 clock: Callable[[], float] = time.time,
                 posts_as_of: str | None = ENVELOPE_TIME):
    """The ``foreachBatch`` callback."""

    def process(batch_df: DataFrame, batch_id: int) -> None:
        now = clock()
        as_of = as_of_fn(batch_id) if as_of_fn else int(now)
        models = registry.get(now) if registry else {}
        # the batch is read by the main plan and by the source key sets: keep
        # it once (a bounded micro-batch) instead of re-reading the source
        games = decoded(batch_df).persist()
        try:
            rows, window = _window_end(games, posts_as_of)
            docs = enrich_documents(rows, _read(posts), _read(reviews), batch_id, as_of, models,
                                    restrict_sources=True, **window)
            write_documents(docs, sink_path, load_id=_load_id(batch_df))
        finally:
            games.unpersist()

    return process


def _values(fresh: DataFrame) -> DataFrame:
    # dealt by key: adaptive execution then writes few files, whatever the joins before left
    return fresh.select("_memo_key", "_memo_at", *SENTIMENT_COLS).repartition("_memo_key")


def _kept_values(store: Snapshots, before: dict, new: dict, latest: int, ttl: int, version: int) -> dict:
    """The state after a batch: parts past their time go, and many become one."""
    bound = latest - MEMO_KEPT_TTLS * ttl
    every = [*before["parts"], new]
    parts = [p for p in every if p["high"] >= bound]
    if len(parts) > store.most:
        rows = store.read(parts, MEMO_VALUES).where(F.col("_memo_at") >= bound)
        parts = [store.write_part(rows.repartition("_memo_key"), f"merged-{version}", high=max(p["high"] for p in parts))]
    # anchors before this time may be missing from now on
    return {"parts": parts, "latest": latest, "gone_before": max(before.get("gone_before", bound), bound)}


def memo_writer(posts: Source, reviews: Source, sink_path: str, values_path: str,
                registry: ModelRegistry | None = None,
                as_of_fn: Callable[[int], int] | None = None,
                clock: Callable[[], float] = time.time,
                posts_as_of: str | None = ENVELOPE_TIME,
                ttl: int = C.MEMO_TTL_SECONDS):
    """``foreachBatch`` callback for batches with memo anchors.

    Only rows that compute a value read the sources, as they are at that batch.
    The values are kept under ``values_path`` as a few folders that a version
    names (``snapshots``): folders past ``MEMO_KEPT_TTLS`` TTLs are dropped,
    those too young for a batch's rows are not read, and a replayed batch starts
    from the version before its own.  Rows outside the sentiment gate take no
    part in any join.
    """

    def process(batch_df: DataFrame, batch_id: int) -> None:
        now = clock()
        as_of = as_of_fn(batch_id) if as_of_fn else int(now)
        models = registry.get(now) if registry else {}
        store = Snapshots(batch_df.sparkSession, values_path)
        before = store.state(batch_id - 1)
        games = batch_df.persist()
        try:
            def scored(rows: DataFrame) -> DataFrame:
                rows, window = _window_end(rows, posts_as_of)
                return with_community_sentiment(rows, _read(posts), _read(reviews), restrict_sources=True,
                                                **window).drop("_until")

            gated = games.where(F.col("_memo_key").isNotNull())
            low, newest, latest = gated.agg(F.min("_memo_at"), F.max(F.when(F.col("_memo_new"), F.col("_memo_at"))),
                                            F.max("_memo_t")).first()
            new = store.write_part(_values(scored(games.where("_memo_new"))), f"batch-{batch_id}",
                                   high=newest if newest is not None else -1)
            parts = [p for p in [*before["parts"], new] if low is not None and p["high"] >= low]
            values = store.read(parts, MEMO_VALUES).where(F.col("_memo_at") >= (low or 0)).withColumn("_found", F.lit(True))
            valued = gated.join(values, ["_memo_key", "_memo_at"], "left")
            if low is not None and low < before.get("gone_before", low):
                # values of late rows are gone: each computes its own
                late = scored(valued.where("_found is null").drop("_found", *SENTIMENT_COLS))
                valued = valued.where("_found").drop("_found").unionByName(late.select(*valued.drop("_found").columns))
            rest = games.where(F.col("_memo_key").isNull()).withColumns({
                "community_sentiment_score": F.lit(C.NEUTRAL_SCORE),
                "community_sentiment_label": F.lit(C.NEUTRAL_LABEL),
                "community_data_volume": F.lit(None).cast("int"),
                "sentiment_source": F.lit(None).cast("string"),
            })
            g = valued.drop("_found").unionByName(rest)
            g = predict_all(g.drop("_memo_key", "_memo_t", "_memo_ts", "_memo_at", "_memo_new"), models)
            g = g.withColumns({
                "predicted_success_score": S.success_score("predicted_success_class"),
                "prediction_confidence": S.prediction_confidence("community_data_volume"),
            })
            write_documents(document(g, batch_id, as_of), sink_path, load_id=_load_id(batch_df))
            latest = max(x for x in (latest, before.get("latest"), -1) if x is not None)
            store.commit(batch_id, _kept_values(store, before, new, latest, ttl, batch_id))
        finally:
            games.unpersist()

    return process


def memo_anchors(parsed: DataFrame, ttl: int = C.MEMO_TTL_SECONDS,
                 watermark: str | None = None) -> DataFrame:
    """Streaming plan: decoded messages -> list scores -> fill -> TTL memo anchors
    keyed by name + week bucket, on the envelope time."""
    g = enrich.fill_defaults(enrich.with_list_scores(decoded(parsed)))
    g = g.withColumns({
        "_memo_key": F.when(sentiment_gate(), memo_key("name", "days_to_release")),
        "_memo_t": F.unix_timestamp(F.to_timestamp("timestamp")),
        "_memo_ts": F.to_timestamp("timestamp"),
    })
    return with_anchors(g, "_memo_key", "_memo_t", "id", ttl, watermark, "_memo_ts")


def start_enrichment(envelope: DataFrame, posts: Source, reviews: Source,
                     sink_path: str, checkpoint: str,
                     registry: ModelRegistry | None = None,
                     as_of_fn: Callable[[int], int] | None = None,
                     available_now: bool = False,
                     processing_time: str | None = None,
                     memo_ttl: int | None = None,
                     memo_watermark: str | None = None,
                     posts_as_of: str | None = ENVELOPE_TIME) -> StreamingQuery:
    """Start the stream; ``checkpoint`` is required (offsets + recovery).

    With ``memo_ttl`` the community sentiment is memoised per name and week
    bucket in keyed streaming state (T3) before the per-batch sink;
    ``memo_watermark`` (e.g. ``"10 minutes"``) evicts expired keys.

    Posts of the month before ``posts_as_of`` count: by default each message's
    own envelope time, else a fixed instant, or all with None.
    ``posts`` and ``reviews`` may be functions; they are called for each
    micro-batch, so that files added since are read."""
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    # each message is parsed once; per-batch load statistics (fetched / sent /
    # failed) are counted on the parsed rows and show in the query progress
    ok = decode_ok()
    parsed = parse(envelope).observe(
        "load_stats", F.count(F.lit(1)).alias("fetched"),
        F.count_if(ok).alias("sent"), F.count_if(~ok).alias("failed"))
    if memo_ttl:
        w = (memo_anchors(parsed, memo_ttl, memo_watermark).writeStream
             .foreachBatch(memo_writer(posts, reviews, sink_path, f"{checkpoint}/memo_values",
                                       registry, as_of_fn, posts_as_of=posts_as_of, ttl=memo_ttl)))
    else:
        w = parsed.writeStream.foreachBatch(
            batch_writer(posts, reviews, sink_path, registry, as_of_fn,
                         posts_as_of=posts_as_of))
    w = w.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
