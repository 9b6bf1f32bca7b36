"""Message sources and the JSON decode of game records.

The envelope contract is ``(timestamp string, value string)``.  It comes from
a Kafka topic in production (``format('kafka')``, options passed through) or
from JSON/Parquet files with the same two columns in tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..schemas import ENVELOPE, STREAM_GAME

CORRUPT = "_corrupt_record"


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 options: dict | None = None) -> DataFrame:
    """Topic subscription cast to the string envelope (needs the Kafka
    connector on the classpath)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(timestamp AS STRING) AS timestamp",
                               "CAST(value AS STRING) AS value")


def file_stream(spark: SparkSession, path: str, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelope files as a stream (same contract as the topic)."""
    r = spark.readStream.schema(ENVELOPE).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _game(value: Column, schema: StructType) -> Column:
    sch = StructType(schema.fields + [StructType().add(CORRUPT, StringType()).fields[0]])
    return F.from_json(value.cast("string"), sch,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _parsed_once(envelope: DataFrame, schema: StructType, keep: list[str]) -> DataFrame:
    """Parse each message exactly once.  The struct is produced by a
    one-element ``explode`` so the decode filter above it cannot be pushed
    below the parse (which would evaluate ``from_json`` a second time)."""
    return envelope.select(*keep, F.explode(F.array(_game(F.col("value"), schema)))
                           .alias("game"))


def is_decoded(game: Column) -> Column:
    return game.isNotNull() & game[CORRUPT].isNull()


def parse(envelope: DataFrame, schema: StructType = STREAM_GAME) -> DataFrame:
    """(timestamp, game): every message parsed, decodable or not."""
    return _parsed_once(envelope, schema, ["timestamp"])


def decoded(parsed: DataFrame, schema: StructType = STREAM_GAME) -> DataFrame:
    """Typed game columns of the parsed messages that decoded."""
    return parsed.where(is_decoded(F.col("game"))).select(
        "timestamp", *[F.col("game")[f.name].alias(f.name) for f in schema.fields])


def decode(envelope: DataFrame, schema: StructType = STREAM_GAME) -> DataFrame:
    """JSON value -> typed game columns next to the envelope timestamp.
    Null/empty values and malformed JSON are dropped here (see
    ``quarantine``), instead of turning into all-null rows."""
    return decoded(parse(envelope, schema), schema)


def quarantine(envelope: DataFrame, schema: StructType = STREAM_GAME) -> DataFrame:
    """Messages that did not decode, with the reason."""
    p = _parsed_once(envelope, schema, ["timestamp", "value"])
    reason = (F.when(F.col("value").isNull(), F.lit("null"))
              .when(F.trim(F.col("value")) == "", F.lit("empty"))
              .otherwise(F.lit("malformed")))
    return p.where(~F.coalesce(is_decoded(F.col("game")), F.lit(False))).select(
        "timestamp", "value", reason.alias("reason"))


def decode_ok() -> Column:
    """Column over parsed messages: True when the message decoded (for load statistics)."""
    return F.coalesce(is_decoded(F.col("game")), F.lit(False))
