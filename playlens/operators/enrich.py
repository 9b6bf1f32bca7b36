"""Game enrichment: raw record -> record with release timing, counts and
scores.  One ``select`` per step; everything is a narrow, codegen'd
projection, so it pipelines with the scan and with what follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import metrics as M
from ..functions import scores as S
from .dimensions import translate_game


def with_release_timing(df: DataFrame, as_of: int,
                        rel: str = "first_release_date") -> DataFrame:
    return df.withColumns({
        "release_date_formatted": M.release_iso(rel),
        "days_since_release": M.days_since_release(as_of, rel),
        "days_to_release": M.days_to_release(as_of, rel),
        "is_released": M.is_released(as_of, rel),
        "is_upcoming": M.is_upcoming(as_of, rel),
    })


def with_counts(df: DataFrame) -> DataFrame:
    """Array counts (null -> 0) and the asset-derived flags."""
    have = set(df.columns)

    def size_of(c):
        return M.safe_size(c) if c in have else F.lit(0)

    out = {
        "franchise_count": size_of("franchises"),
        "platform_count": size_of("platforms"),
        "genre_count": size_of("genres"),
    }
    if "involved_companies" in have:
        out.update({
            "company_count": size_of("involved_companies"),
            "video_count": size_of("videos"),
            "screenshot_count": size_of("screenshots"),
            "website_count": size_of("websites"),
            "marketing_intensity": (size_of("videos") + size_of("screenshots")
                                    + size_of("artworks")).cast("int"),
            "has_multiplayer": size_of("game_modes") > 1,
            "has_expansions": size_of("expansions") > 0,
        })
    return df.withColumns(out)


def with_scores(df: DataFrame) -> DataFrame:
    """hype / longevity / success (needs timing and counts)."""
    return df.withColumns({
        "hype_score": M.hype_score(),
        "longevity_score": M.longevity_score(),
        "success_level": M.success_level(),
    })


def derive_metrics(raw: DataFrame, as_of: int) -> DataFrame:
    """All crawler metrics of a raw game (ids or names in the list columns)."""
    return with_scores(with_counts(with_release_timing(raw, as_of)))


def crawl_transform(raw: DataFrame, dims: dict, as_of: int,
                    strategy: str = "auto") -> DataFrame:
    """Raw API games -> topic records: translate once, then metrics."""
    return derive_metrics(translate_game(raw, dims, strategy), as_of)


def with_list_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "genre_popularity_score": S.genre_popularity_score("genres"),
        "platform_reach_score": S.platform_reach_score("platforms"),
    })


def fill_defaults(df: DataFrame, fills: dict | None = None) -> DataFrame:
    """Per-column null fill (only for columns present)."""
    fills = C.STREAM_FILLS if fills is None else fills
    present = {k: v for k, v in fills.items() if k in df.columns}
    return df.na.fill(present) if present else df


BULK_ARRAYS = ["franchises", "genre_ids", "platform_ids", "theme_ids",
               "game_mode_ids", "player_perspective_ids", "involved_companies",
               "genres", "platforms", "game_modes", "themes",
               "player_perspectives", "screenshots", "videos", "artworks",
               "websites", "similar_games", "expansions", "bundles"]


def bulk_document(raw: DataFrame, dims: dict, as_of: int,
                  strategy: str = "auto") -> DataFrame:
    """Bulk-import document: ids + names + assets + metrics + timestamps.
    Missing list fields become [] and hypes/follows default to 0 (the declared
    schema reads an absent field as null, so every null counts as absent)."""
    g = crawl_transform(raw, dims, as_of, strategy)
    arrays = [F.coalesce(F.col(a), F.array().cast(g.schema[a].dataType)).alias(a)
              for a in BULK_ARRAYS]
    return g.select(
        F.col("id").alias("game_id"), "name", "rating", "rating_count",
        "total_rating", "total_rating_count", "aggregated_rating",
        "aggregated_rating_count",
        F.coalesce("hypes", F.lit(0)).alias("hypes"),
        F.coalesce("follows", F.lit(0)).alias("follows"), "category", "status",
        *arrays,
        "release_date_formatted", "days_since_release", "days_to_release",
        "is_released", "is_upcoming", "franchise_count", "platform_count",
        "genre_count", "company_count", "video_count", "screenshot_count",
        "website_count", "marketing_intensity", "hype_score",
        "longevity_score", "success_level", "has_multiplayer",
        "has_expansions",
        F.col("first_release_date").alias("release_date"),
        F.date_format(F.timestamp_seconds(F.lit(as_of)),
                      "yyyy-MM-dd'T'HH:mm:ss").alias("ingestion_time"),
        F.lit(as_of).cast("long").alias("processed_timestamp"),
        # bulk key: game and load time (a re-run of the same load is the same key)
        F.concat_ws("_", F.col("id").cast("string"), F.lit(str(as_of))).alias("doc_id"),
    )
