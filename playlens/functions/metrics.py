"""Release-timing, hype, longevity, success and count metrics as Column
expressions.  ``as_of`` (epoch seconds) is always explicit so plans are
deterministic and constant-foldable; nothing reads the wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(v: float) -> Column:
    return F.lit(float(v))


def release_epoch(rel="first_release_date") -> Column:
    """Release epoch, null when missing or 0 (both mean 'no date')."""
    r = _c(rel)
    return F.when(r.isNull() | (r == 0), F.lit(None).cast("long")).otherwise(r.cast("long"))


def days_since_release(as_of: int, rel="first_release_date") -> Column:
    """Whole days since release, floored (12 h ahead gives -1)."""
    return F.floor((F.lit(as_of) - release_epoch(rel)) / C.SECONDS_PER_DAY).cast("int")


def days_to_release(as_of: int, rel="first_release_date") -> Column:
    """Whole days until release, floored (12 h ago gives -1)."""
    return F.floor((release_epoch(rel) - F.lit(as_of)) / C.SECONDS_PER_DAY).cast("int")


def is_released(as_of: int, rel="first_release_date") -> Column:
    return F.coalesce(days_since_release(as_of, rel) >= 0, F.lit(False))


def is_upcoming(as_of: int, rel="first_release_date") -> Column:
    return F.coalesce(days_to_release(as_of, rel) >= 0, F.lit(False))


def release_ts(rel="first_release_date") -> Column:
    return F.timestamp_seconds(release_epoch(rel))


def release_iso(rel="first_release_date") -> Column:
    """ISO-8601 text of the release instant (UTC session), null-safe."""
    return F.date_format(release_ts(rel), "yyyy-MM-dd'T'HH:mm:ss")


def safe_size(arr) -> Column:
    """Array length with null counted as 0."""
    a = _c(arr)
    return F.when(a.isNull(), F.lit(0)).otherwise(F.size(a)).cast("int")


def hype_score(days_to="days_to_release", upcoming="is_upcoming", hypes="hypes",
               follows="follows", rating_count="rating_count") -> Column:
    """min(100, (2*hypes + 1.5*follows + 0.5*count) * time_factor / 10) for
    upcoming games; the time factor falls linearly to 0 at a year, then
    jumps to 0.3 beyond."""
    d = _c(days_to)
    tf = F.when(d <= C.HYPE_HORIZON_DAYS,
                F.greatest(_d(0.0), _d(1.0) - d / C.DAYS_PER_YEAR)
                ).otherwise(_d(C.HYPE_FAR_FACTOR))
    raw = (F.coalesce(_c(hypes), F.lit(0)) * C.HYPE_WEIGHT
           + F.coalesce(_c(follows), F.lit(0)) * C.FOLLOW_WEIGHT
           + F.coalesce(_c(rating_count), F.lit(0)) * C.ANTICIPATION_WEIGHT) * tf
    return F.when(_c(upcoming) & d.isNotNull() & (d >= 0),
                  F.least(_d(C.SCORE_CAP), raw / C.HYPE_DIVISOR))


def longevity_score(days_since="days_since_release", released="is_released",
                    rating="rating", rating_count="rating_count",
                    franchise_count="franchise_count",
                    platform_count="platform_count") -> Column:
    """Weighted quality/popularity/franchise/platform/age blend for games
    released at least one day ago."""
    s = _c(days_since)
    years = s / C.DAYS_PER_YEAR
    age = F.when(years > 1, F.least(_d(1.0), years / C.AGE_FULL_AT_YEARS)
                 ).otherwise(_d(C.YOUNG_AGE_FACTOR))
    score = (F.coalesce(_c(rating), _d(0.0)) / 100.0 * C.QUALITY_WEIGHT
             + F.least(_d(1.0), F.coalesce(_c(rating_count), F.lit(0)) / C.POPULARITY_FULL_AT)
             * C.POPULARITY_WEIGHT
             + F.least(_d(1.0), _c(franchise_count) / C.FRANCHISE_FULL_AT) * C.FRANCHISE_WEIGHT
             + F.least(_d(1.0), _c(platform_count) / C.PLATFORM_FULL_AT) * C.PLATFORM_WEIGHT
             + age * C.AGE_WEIGHT)
    return F.when(_c(released) & s.isNotNull() & (s > 0), score)


def success_level(rating="rating", rating_count="rating_count") -> Column:
    """2 hit / 1 medium / 0 flop; null when rating or count is null or 0."""
    r, n = _c(rating), _c(rating_count)
    out = F.lit(C.SUCCESS_FLOOR)
    for level, min_r, min_n in reversed(C.SUCCESS_TIERS):
        out = F.when((r >= min_r) & (n >= min_n), F.lit(level)).otherwise(out)
    known = r.isNotNull() & (r != 0) & n.isNotNull() & (n != 0)
    return F.when(known, out).cast("int")


def marketing_intensity(videos="videos", screenshots="screenshots",
                        artworks="artworks") -> Column:
    return (safe_size(videos) + safe_size(screenshots) + safe_size(artworks)).cast("int")


def has_multiplayer(game_modes="game_modes") -> Column:
    return safe_size(game_modes) > 1


def has_expansions(expansions="expansions") -> Column:
    return safe_size(expansions) > 0
