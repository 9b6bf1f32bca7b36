"""Declared schemas and the adapter that conforms any frame to one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               VariantType)

_I, _L, _D, _S, _B = IntegerType(), LongType(), DoubleType(), StringType(), BooleanType()
_AI, _AS = ArrayType(IntegerType()), ArrayType(StringType())


def _struct(fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Game as returned by the source API: every id array holds ints.
RAW_ID_ARRAYS = ["franchises", "genres", "platforms", "themes", "game_modes",
                 "player_perspectives", "involved_companies", "screenshots",
                 "videos", "artworks", "websites", "similar_games", "expansions",
                 "bundles"]
RAW_GAME = _struct([
    ("id", _I), ("name", _S), ("category", _I), ("status", _I),
    ("rating", _D), ("rating_count", _I), ("aggregated_rating", _D),
    ("aggregated_rating_count", _I), ("total_rating", _D),
    ("total_rating_count", _I), ("hypes", _I), ("follows", _I),
    ("first_release_date", _L),
] + [(a, _AI) for a in RAW_ID_ARRAYS])

# Arrays whose elements some sources give as names instead of ids: read as
# VARIANT, so that either survives the reader.
RAW_NAMED_ARRAYS = ["genres", "platforms", "themes", "game_modes", "player_perspectives"]
RAW_MIXED_GAME = _struct([
    (f.name, ArrayType(VariantType()) if f.name in RAW_NAMED_ARRAYS else f.dataType)
    for f in RAW_GAME.fields])

# Game record on the message topic (translated names + crawler metrics).
STREAM_GAME = _struct([
    ("id", _I), ("name", _S), ("rating", _D), ("rating_count", _I),
    ("hypes", _I), ("follows", _I), ("release_date", _L),
    ("first_release_date", _L), ("category", _I), ("status", _I),
    ("total_rating", _D), ("total_rating_count", _I),
    ("aggregated_rating", _D), ("aggregated_rating_count", _I),
    ("franchises", _AI),
    ("genres", _AS), ("platforms", _AS), ("game_modes", _AS), ("themes", _AS),
    ("player_perspectives", _AS),
    ("genre_ids", _AI), ("platform_ids", _AI), ("game_mode_ids", _AI),
    ("theme_ids", _AI), ("player_perspective_ids", _AI),
    ("days_since_release", _I), ("days_to_release", _I),
    ("is_released", _B), ("is_upcoming", _B),
    ("franchise_count", _I), ("platform_count", _I), ("genre_count", _I),
    ("hype_score", _D), ("longevity_score", _D), ("success_level", _I),
])

# Historical record read back from the document store (training input).
HISTORY = _struct([
    ("game_id", _I), ("name", _S), ("rating", _D), ("rating_count", _I),
    ("total_rating", _D), ("aggregated_rating", _D), ("hypes", _I),
    ("follows", _I), ("release_date", _S), ("days_to_release", _I),
    ("days_since_release", _I), ("is_released", _B), ("is_upcoming", _B),
    ("franchise_count", _I), ("platform_count", _I), ("genre_count", _I),
    ("hype_score", _D), ("longevity_score", _D), ("success_level", _I),
    ("genres", _AS), ("platforms", _AS), ("game_modes", _AS), ("themes", _AS),
    ("community_sentiment_score", _D),
])

# Enriched output document.
DOCUMENT = _struct([
    ("game_id", _I), ("name", _S), ("rating", _D), ("rating_count", _I),
    ("total_rating", _D), ("aggregated_rating", _D), ("hypes", _I),
    ("follows", _I), ("release_date", _S), ("days_to_release", _I),
    ("days_since_release", _I), ("is_released", _B), ("is_upcoming", _B),
    ("franchise_count", _I), ("platform_count", _I), ("genre_count", _I),
    ("genres", _AS), ("platforms", _AS), ("game_modes", _AS), ("themes", _AS),
    ("player_perspectives", _AS),
    ("genre_popularity_score", _D), ("platform_reach_score", _D),
    ("hype_score", _D), ("longevity_score", _D), ("success_level", _I),
    ("community_sentiment_score", _D), ("community_sentiment_label", _S),
    ("community_data_volume", _I), ("sentiment_source", _S),
    ("predicted_rating", _D), ("predicted_rating_count", _D),
    ("predicted_longevity", _D), ("predicted_success_class", _D),
    ("predicted_success_score", _D), ("prediction_confidence", _D),
    ("batch_id", _L), ("processed_timestamp", _L), ("ingestion_time", _S),
])

# Message envelope as it leaves the topic.
ENVELOPE = _struct([("timestamp", _S), ("value", _S)])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become typed nulls,
    extra columns are dropped, present ones are cast with ``try_cast`` so a
    bad value becomes null instead of failing the job."""
    have = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        if f.name in have:
            src = F.col(f.name)
            if df.schema[f.name].dataType != f.dataType:
                src = src.try_cast(f.dataType)
            cols.append(src.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
