"""Batch and streaming jobs built from the operators (one action each).

* ``bulk_import``  : raw API-shaped JSON -> bulk documents, appended
* ``crawl``        : recent/upcoming top-k -> topic messages
* ``train``        : history documents -> versioned models in a shared folder
* ``stream``       : topic/file envelope -> enriched documents (foreachBatch)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import enrich, ml
from ..operators import selection as sel
from ..schemas import HISTORY, RAW_GAME, RAW_MIXED_GAME, conform
from ..sinks import documents as sinks
from ..streaming.pipeline import start_enrichment


def read_raw_games(spark: SparkSession, path: str, fmt: str = "json", mixed: bool = False) -> DataFrame:
    """Raw games with the declared schema (no inference); ``mixed`` for sources
    whose list fields hold ids and names."""
    return spark.read.schema(RAW_MIXED_GAME if mixed else RAW_GAME).format(fmt).load(path)


def bulk_import(raw: DataFrame, dims: dict, out_path: str, as_of: int,
                bound_epoch: int | None = None) -> DataFrame:
    """All games released since ``bound_epoch`` (default 2005-01-01) ->
    bulk documents appended to ``out_path``; returns the statistics of this
    load, counted while it is written."""
    bound = bound_epoch if bound_epoch is not None else int(
        raw.sparkSession.sql(f"SELECT unix_timestamp(timestamp'{C.BULK_LOWER_BOUND}')")
        .first()[0])
    docs = enrich.bulk_document(sel.released_since(raw, bound), dims, as_of)
    seen = Observation("bulk_import")
    sinks.append_documents(docs.observe(seen, F.count(F.lit(1)).alias("documents")), out_path)
    return raw.sparkSession.createDataFrame([(seen.get["documents"],)], "documents long")


def crawl(raw: DataFrame, dims: dict, as_of: int, k: int = C.RECENT_TOP_K) -> DataFrame:
    """Crawl batch as ``(key, value)`` messages: released in the last 60 days
    or upcoming, top ``k`` by hypes, translated once, metrics added."""
    batch = enrich.crawl_transform(sel.top_hyped(sel.recent_window(raw, as_of), k), dims, as_of)
    return sinks.encode(batch)


def train(history: DataFrame, model_root: str, version: str, names=None) -> dict:
    """Fit the models on conformed history and publish them as a new version
    under ``model_root`` (the stream's registry follows ``_latest``)."""
    h = conform(history, HISTORY)
    models = ml.train_models(h, names)
    if models:
        ml.publish_models(history.sparkSession, models, model_root, version)
    return models


def stream(envelope: DataFrame, posts: DataFrame, reviews: DataFrame, sink_path: str,
           checkpoint: str, model_path: str | None = None, **kw):
    """Start the enrichment stream; models reload hourly from ``model_path``."""
    registry = ml.ModelRegistry(model_path, spark=envelope.sparkSession) if model_path else None
    return start_enrichment(envelope, posts, reviews, sink_path, checkpoint, registry, **kw)
