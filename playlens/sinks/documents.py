"""Output documents: projection, keys, JSON encoding, idempotent writes and
load statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .. import constants as C
from ..schemas import DOCUMENT, HISTORY, conform

LIST_FIELDS = ["genres", "platforms", "game_modes", "themes", "player_perspectives"]
ZERO_DEFAULTS = ["hypes", "follows"]


def iso_of(epoch: int) -> Column:
    return F.date_format(F.timestamp_seconds(F.lit(epoch)), "yyyy-MM-dd'T'HH:mm:ss")


def document(enriched: DataFrame, batch_id: int, as_of: int) -> DataFrame:
    """Project an enriched game frame onto the 39-field document.

    ``id`` becomes ``game_id``; hypes/follows default to 0 and list fields to
    []; prediction columns a frame lacks are typed nulls; batch id and
    processing time are pinned literals (``as_of`` is fixed per batch so a
    replay writes identical documents).
    """
    have = set(enriched.columns)
    cols = []
    for f in DOCUMENT.fields:
        n = f.name
        if n == "game_id":
            c = F.col("id")
        elif n == "release_date":
            c = F.col("release_date_formatted") if "release_date_formatted" in have \
                else F.lit(None)
        elif n == "batch_id":
            c = F.lit(batch_id)
        elif n == "processed_timestamp":
            c = F.lit(as_of)
        elif n == "ingestion_time":
            c = iso_of(as_of)
        elif n in have:
            c = F.col(n)
            if n in ZERO_DEFAULTS:
                c = F.coalesce(c, F.lit(0))
            elif n in LIST_FIELDS:
                c = F.coalesce(c, F.array().cast(ArrayType(StringType())))
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(n))
    return enriched.select(*cols)


def doc_key(game_id: str = "game_id", batch_id: str = "batch_id",
            load_id: str | None = None) -> Column:
    """Deterministic document key ``<game>_<batch>``, with ``load_id`` (a
    column) ``<game>_<load>_<batch>``: a replayed batch rewrites the same keys
    instead of inserting new ones."""
    parts = [game_id, *([load_id] if load_id else []), batch_id]
    return F.concat_ws("_", *[F.col(c).cast("string") for c in parts])


def encode(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows -> ``(key, value)`` JSON messages (null fields omitted)."""
    fields = [F.col(c) for c in df.columns]
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*fields)).alias("value"))


def write_documents(docs: DataFrame, path: str, fmt: str = "parquet",
                    load_id: str = "0") -> None:
    """Idempotent write: each batch of a load owns its ``load_id, batch_id``
    partition, and a replay overwrites exactly that one (dynamic partition
    overwrite).  ``load_id`` names the writer - for a stream the id kept in its
    checkpoint - because batch numbers start anew with every checkpoint."""
    (docs.withColumn("load_id", F.lit(load_id))
     .withColumn("doc_id", doc_key(load_id="load_id"))
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_id", "batch_id")
     .format(fmt).save(path))


def append_documents(docs: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Bulk append (the back-fill path)."""
    docs.write.mode("append").format(fmt).save(path)


def read_history(spark: SparkSession, stream_path: str | None = None,
                 bulk_path: str | None = None) -> DataFrame:
    """The stored history of both writers in one form (HISTORY, filled).

    Bulk documents keep the release as epoch seconds next to its ISO text; the
    stream keeps the text, which is the form history has."""
    parts = []
    if stream_path:
        parts.append(spark.read.parquet(stream_path))
    if bulk_path:
        parts.append(spark.read.parquet(bulk_path).drop("release_date")
                     .withColumnRenamed("release_date_formatted", "release_date"))
    if not parts:
        raise ValueError("no stored history given")
    out = conform(parts[0], HISTORY)
    for p in parts[1:]:
        out = out.unionByName(conform(p, HISTORY))
    return out.na.fill(C.HISTORY_FILLS)


def write_messages(messages: DataFrame, fmt: str, options: dict | None = None,
                   path: str | None = None) -> None:
    """Produce ``(key, value)`` messages: ``fmt='kafka'`` with options such as
    ``kafka.bootstrap.servers`` and ``topic``, or a file format for tests."""
    w = messages.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        w.save()
    else:
        w.mode("append").save(path)


def load_stats(envelope: DataFrame, decoded_ok: Column) -> DataFrame:
    """fetched / sent / failed in one aggregation pass."""
    return envelope.agg(
        F.count(F.lit(1)).cast("long").alias("fetched"),
        F.count_if(decoded_ok).cast("long").alias("sent"),
        F.count_if(~decoded_ok).cast("long").alias("failed"),
    )
