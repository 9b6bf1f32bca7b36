"""Filters, splits, top-k and paging over game frames.

Filters compare stored columns with literals (``first_release_date`` epoch),
never a derived expression, so they reach the Parquet scan as pushed
filters when the frame is read from storage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .ranking import row_number_by, top_k_per_group


def upcoming_window(df: DataFrame, lo: int = C.SENTIMENT_MIN_DAYS,
                    hi: int = C.SENTIMENT_MAX_DAYS) -> DataFrame:
    """Upcoming games ``lo..hi`` days ahead."""
    d = F.col("days_to_release")
    return df.where(F.col("is_upcoming") & d.between(lo, hi))


def released_since(df: DataFrame, bound_epoch: int,
                   rel: str = "first_release_date") -> DataFrame:
    """Games released at or after an absolute bound (epoch seconds)."""
    return df.where(F.col(rel) >= F.lit(bound_epoch))


def recent_window(df: DataFrame, as_of: int, days: int = C.RECENT_WINDOW_DAYS,
                  rel: str = "first_release_date") -> DataFrame:
    """Released in the last ``days`` days before ``as_of`` or later."""
    return released_since(df, as_of - days * C.SECONDS_PER_DAY, rel)


def hype_order(hypes: str = "hypes", key: str = "id") -> list[Column]:
    return [F.col(hypes).desc_nulls_last(), F.col(key).asc()]


def top_ids(df: DataFrame, k: int = C.RECENT_TOP_K, key: str = "id") -> DataFrame:
    """Ids (``id``) of the top ``k`` by hypes (nulls last, id breaks ties).

    Only two columns are ranked: TakeOrderedAndProject, each task keeps k rows."""
    return (df.select(F.col(key).alias("id"), "hypes").orderBy(*hype_order()).limit(k)
            .select("id"))


def top_hyped(df: DataFrame, k: int = C.RECENT_TOP_K, key: str = "id") -> DataFrame:
    """Top ``k`` rows by hypes; ids are unique.  The ``k`` winning ids, a
    bounded set, are joined back to their wide rows: an ``orderBy().limit()``
    of the wide rows below further projections would be a full sort."""
    top = top_ids(df, k, key).withColumnRenamed("id", "_top")
    return df.join(F.broadcast(top), df[key] == top["_top"], "left_semi")


def split_label(upcoming: str = "is_upcoming") -> Column:
    """Upcoming wins; released and undated games fall in 'released'."""
    return F.when(F.coalesce(F.col(upcoming), F.lit(False)),
                  F.lit("upcoming")).otherwise(F.lit("released"))


def release_split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(split_label().alias("split")).agg(
        F.count(F.lit(1)).cast("int").alias("n"))


def preview_list(arr: str, n: int = C.PREVIEW_ITEMS) -> Column:
    """First ``n`` items joined by ', ', or 'N/A' when empty or null."""
    a = F.col(arr)
    return F.when(a.isNull() | (F.size(a) == 0), F.lit(C.PREVIEW_EMPTY)) \
        .otherwise(F.array_join(F.slice(a, 1, n), ", "))


def split_preview(df: DataFrame, k: int = C.PREVIEW_ROWS) -> DataFrame:
    """First ``k`` games per split in batch (hype) order, with preview text."""
    s = df.withColumn("split", split_label())
    top = top_k_per_group(s, ["split"], hype_order(), k, "position")
    up = F.col("split") == "upcoming"
    return top.select(
        "split", "position", "id",
        F.substring("name", 1, 40).alias("name"),
        F.when(up, F.col("days_to_release")).otherwise(F.col("days_since_release"))
        .alias("days"),
        F.when(up, F.col("hype_score")).otherwise(F.col("rating")).alias("metric"),
        preview_list("genres").alias("genres_preview"),
        preview_list("platforms").alias("platforms_preview"),
    )


def release_order(rel: str = "first_release_date", key: str = "id") -> list[Column]:
    return [F.col(rel).asc(), F.col(key).asc()]


def release_page(df: DataFrame, bound_epoch: int, page: int,
                 size: int = C.BULK_PAGE_SIZE, rel: str = "first_release_date") -> DataFrame:
    """One page (0-based) of games released since the bound, oldest first."""
    return (released_since(df, bound_epoch, rel).orderBy(*release_order(rel))
            .offset(page * size).limit(size))


def release_page_after(df: DataFrame, bound_epoch: int, after: tuple[int, int] | None,
                       size: int = C.BULK_PAGE_SIZE,
                       rel: str = "first_release_date") -> DataFrame:
    """Keyset paging: the ``size`` games following the key ``after`` =
    ``(release, id)`` of the previous page's last row.  Unlike ``offset``,
    every task keeps only ``size`` rows however deep the page is, and the
    release bound still reaches the scan."""
    r = released_since(df, bound_epoch, rel)
    if after is not None:
        a_rel, a_id = after
        r = r.where((F.col(rel) > F.lit(a_rel))
                    | ((F.col(rel) == F.lit(a_rel)) & (F.col("id") > F.lit(a_id))))
    return r.orderBy(*release_order(rel)).limit(size)


def release_pages(df: DataFrame, bound_epoch: int, size: int = C.BULK_PAGE_SIZE,
                  rel: str = "first_release_date") -> DataFrame:
    """Every game since the bound with its page number and position: the
    whole load in one pass (no paging loop).  Rows are numbered in slices of
    one release instant and a block of 2^20 ids (monotone in the ordering),
    so a day holding a huge share of games is still split; slice offsets are
    summed within a day, day totals across days (two small windows)."""
    r = released_since(df, bound_epoch, rel)
    slice_ = F.struct(F.col(rel).alias("r"), F.shiftright(F.col("id"), 20).alias("b"))
    day = F.floor(F.col(rel) / C.SECONDS_PER_DAY)
    n = row_number_by(r, [], release_order(rel), slice_, "_rn", coarse=day)
    return (n.withColumn("page", ((F.col("_rn") - 1) / size).cast("int"))
            .withColumn("position", ((F.col("_rn") - 1) % size + 1).cast("int"))
            .drop("_rn"))
