"""Community sentiment as joins and aggregations.

Per-game source scores are pre-aggregated to one row per key *before* they
meet the games, so the left joins never fan out (duplicate ids stay as they
are) and a hot game is reduced by map-side partial aggregation instead of
being shipped whole to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scores as S
from ..functions import sentiment as X
from .ranking import top_k_per_group


def _relevance(posts: DataFrame) -> list[str]:
    """Relevance order of posts: their rank if they have one, else time and event."""
    return ["rank"] if "rank" in posts.columns else ["posted_at", "event_id"]


def post_sentiment(posts: DataFrame, key: str = "game_id",
                   scored: int = C.POSTS_SCORED) -> DataFrame:
    """Per game: mean sentiment of the first ``scored`` posts by relevance
    (0-100), its label, the volume of all posts and the summed vote score of
    the scored posts.  The first posts come from a salted two-phase top-k, the
    volume from a plain count: no post beyond them is ranked or sorted."""
    s = X.post_sentiment("title", "score")
    volume = posts.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("post_volume"))
    first = top_k_per_group(posts, [key], _relevance(posts), scored, "_place")
    agg = first.groupBy(key).agg(
        F.avg(s).alias("_avg"),
        F.count(F.lit(1)).cast("int").alias("scored_posts"),
        F.sum("score").cast("long").alias("total_post_score"),
    ).withColumnRenamed(key, "_game")
    score = X.rescale("_avg")
    return volume.join(agg, volume[key].eqNullSafe(agg["_game"])).select(
        key, "post_volume", "scored_posts", "total_post_score",
        score.alias("reddit_score"), X.label(score).alias("reddit_label"))


def posts_in_window(posts: DataFrame, as_of: str | Column, days: int = C.POSTS_WINDOW_DAYS,
                    ts: str = "posted_at") -> DataFrame:
    """Posts with ``as_of - days <= ts <= as_of`` (pushed to the scan)."""
    hi = as_of if isinstance(as_of, Column) else F.to_timestamp(F.lit(as_of))
    lo = hi - F.make_interval(days=F.lit(days))
    return posts.where((F.col(ts) >= lo) & (F.col(ts) <= hi))


def posts_before(rows: DataFrame, posts: DataFrame, until: str, key: str = "id",
                 post_key: str = "game_id", days: int = C.POSTS_WINDOW_DAYS,
                 scored: int = C.POSTS_SCORED, ts: str = "posted_at") -> DataFrame:
    """``(game_id, until, post_volume, reddit_score, reddit_label)`` of each
    distinct game and time of ``rows``: the posts of the ``days`` days up to
    that time, both ends included, and the mean over the first of them.

    Posts that have a rank meet the windows by game and bucket of ``days`` days
    (a window touches two).  Posts in time order need no pairs: they are
    numbered and summed up once, a window looks up where it begins and ends,
    and the sum at its last scored post comes by (game, number).  A row without
    a time has no window."""
    windows = (rows.where(F.col(until).isNotNull())
               .select(F.col(key).cast(posts.schema[post_key].dataType).alias("_g"), F.col(until).alias("_until")).distinct())
    if "rank" in posts.columns:
        found = _ranked_before(windows, posts, post_key, days, scored, ts)
    else:
        found = _timed_before(windows, posts, post_key, days, scored, ts)
    score = F.coalesce(F.col("reddit_score"), F.lit(0.0))
    return found.select(F.col("_g").alias("game_id"), F.col("_until").alias("until"), "post_volume",
                        score.alias("reddit_score"), X.label(score).alias("reddit_label"))


def _ranked_before(windows: DataFrame, posts: DataFrame, post_key: str, days: int, scored: int, ts: str) -> DataFrame:
    span = days * C.SECONDS_PER_DAY
    number = F.floor(F.unix_seconds("_until") / span)
    dealt = windows.withColumn("_bucket", F.explode(F.array(number - 1, number)))
    p = posts.withColumn("_bucket", F.floor(F.unix_seconds(ts) / span)).withColumnRenamed(post_key, "_g")
    met = posts_in_window(p.join(dealt, ["_g", "_bucket"]), F.col("_until"), days, ts)
    return post_sentiment(met.withColumn("_w", F.struct("_g", "_until")), "_w", scored).select(
        "_w.*", "post_volume", "reddit_score")


def _timed_before(windows: DataFrame, posts: DataFrame, post_key: str, days: int, scored: int, ts: str) -> DataFrame:
    lo = F.col("_until") - F.make_interval(days=F.lit(days))
    exact = "decimal(18, 9)"                               # differences of sums must not lose digits
    none = [F.lit(None).cast(posts.schema["event_id"].dataType).alias("event_id"), F.lit(0).alias("_one"), F.lit(0).cast(exact).alias("_s")]
    # at equal times: a window's begin, the posts, a window's end
    marks = windows.select("_g", F.explode(F.array(
        F.struct(lo.alias("_t"), F.lit(0).alias("_kind")), F.struct(F.col("_until").alias("_t"), F.lit(2).alias("_kind")))).alias("m"),
        "_until", *none).select("_g", "m.*", "_until", "event_id", "_one", "_s")
    timed = posts.where(F.col(ts).isNotNull()).select(
        F.col(post_key).alias("_g"), F.col(ts).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast("timestamp").alias("_until"),
        "event_id", F.lit(1).alias("_one"), F.coalesce(X.post_sentiment("title", "score"), F.lit(0.0)).cast(exact).alias("_s"))
    # running counts and sums within a game's day, then those of its days before
    every = timed.unionByName(marks).withColumn("_day", F.floor(F.unix_seconds("_t") / C.SECONDS_PER_DAY))
    inner = Window.partitionBy("_g", "_day").orderBy("_t", "_kind", "event_id", "_s").rowsBetween(Window.unboundedPreceding, 0)
    local = every.withColumns({"_n": F.sum("_one").over(inner), "_sum": F.sum("_s").over(inner)})
    before = Window.partitionBy("_g").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    totals = every.groupBy("_g", "_day").agg(F.sum("_one").alias("_n"), F.sum("_s").alias("_sum"))
    offsets = totals.select("_g", "_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
                            F.coalesce(F.sum("_sum").over(before), F.lit(0).cast(exact)).alias("_sum0"))
    run = local.join(offsets, ["_g", "_day"]).select(
        "_g", "_kind", "_until", (F.col("_n") + F.col("_n0")).alias("_n"), (F.col("_sum") + F.col("_sum0")).alias("_sum"))
    begin, end = F.col("_kind") == 0, F.col("_kind") == 2
    edges = run.where("_kind != 1").groupBy("_g", "_until").agg(
        F.max(F.when(begin, F.col("_n"))).alias("_first"), F.max_by("_sum", F.when(begin, 1)).alias("_sum_first"),
        F.max(F.when(end, F.col("_n"))).alias("_end"))
    edges = edges.where("_end > _first").withColumn("_n", F.least(F.col("_first") + scored, F.col("_end")))
    mean = (F.col("_sum") - F.col("_sum_first")).cast("double") / (F.col("_n") - F.col("_first"))
    return edges.join(run.where("_kind = 1").select("_g", "_n", "_sum"), ["_g", "_n"]).select(
        "_g", "_until", (F.col("_end") - F.col("_first")).cast("int").alias("post_volume"), X.rescale(mean).alias("reddit_score"))


def posts_last_month(games: DataFrame, posts: DataFrame, as_of: str,
                     key: str = "id", post_key: str = "game_id") -> DataFrame:
    """Games left-joined to their posts of the last month: the window comes
    first, then the first posts within it.  A game without posts in the window
    scores 0.0, as the source did answer."""
    recent = post_sentiment(posts_in_window(posts, as_of), post_key)
    j = games.select(key).join(recent, games[key] == recent[post_key], "left")
    return j.select(
        F.col(key),
        F.coalesce("post_volume", F.lit(0)).alias("month_post_volume"),
        F.coalesce("reddit_score", F.lit(0.0)).alias("month_reddit_score"),
    )


def review_scores(reviews: DataFrame) -> DataFrame:
    """Per slug: user score x 10 and its label (a slug listed twice keeps
    the page with the lowest key)."""
    r = reviews.select("slug", "game_id",
                       X.review_user_score("html").alias("metacritic_score"))
    per_slug = r.groupBy("slug").agg(
        F.min_by("metacritic_score", "game_id").alias("metacritic_score"))
    return per_slug.withColumn("metacritic_label", X.review_label("metacritic_score"))


def with_review_scores(games: DataFrame, reviews: DataFrame,
                       name: str = "name") -> DataFrame:
    """Games left-joined to review pages on the name slug."""
    g = games.withColumn("_slug", X.name_slug(name))
    r = review_scores(reviews).withColumnRenamed("slug", "_slug")
    return g.join(r, "_slug", "left").drop("_slug")


def sentiment_gate(days_to="days_to_release", upcoming="is_upcoming"):
    """Only upcoming games 1..365 days ahead get community sentiment."""
    d = F.col(days_to)
    return (F.coalesce(F.col(upcoming), F.lit(False)) & d.isNotNull()
            & (d >= C.SENTIMENT_MIN_DAYS) & (d <= C.SENTIMENT_MAX_DAYS))


def with_community_sentiment(games: DataFrame, posts: DataFrame,
                             reviews: DataFrame, key: str = "id",
                             posts_available: bool = True,
                             zero_is_missing: bool = True,
                             restrict_sources: bool = False,
                             posts_as_of: str | Column | None = None,
                             posts_until: str | None = None) -> DataFrame:
    """Blend posts (0.4), review page (0.3) and native engagement (0.3) into
    ``community_sentiment_score/label``, ``community_data_volume`` and
    ``sentiment_source``.

    ``posts_available``: the post source answered, so a game without posts
    scores 0.0 (and still enters the mean); ``False`` drops the source.
    ``zero_is_missing``: a final 0.0 is replaced by 50.0, label kept.
    ``restrict_sources``: for a small ``games`` frame (a micro-batch), keep
    only the posts and pages of those games (left-semi join, broadcast when
    AQE measures the key set small) before aggregating, instead of
    re-aggregating the whole source tables per batch.
    ``posts_as_of``: only posts of the month before this instant count.
    ``posts_until``: a timestamp column of ``games``; posts of the month before
    each row's own time count.
    """
    if posts_as_of is not None:
        posts = posts_in_window(posts, posts_as_of)
    if restrict_sources:
        keys = games.select(F.col(key).alias("_gk")).distinct()
        posts = posts.join(keys, posts["game_id"] == keys["_gk"], "left_semi")
        slugs = games.select(X.name_slug("name").alias("_gs")).distinct()
        reviews = reviews.join(slugs, reviews["slug"] == slugs["_gs"], "left_semi")
    scores = post_sentiment(posts) if posts_until is None else posts_before(games, posts, posts_until, key)
    return blend_sources(games, scores, review_scores(reviews), key,
                         posts_available, zero_is_missing, posts_until)


def blend_sources(games: DataFrame, post_scores: DataFrame, review_table: DataFrame,
                  key: str = "id", posts_available: bool = True,
                  zero_is_missing: bool = True, posts_until: str | None = None) -> DataFrame:
    """The blend over pre-aggregated sources (one row per game / per slug; with
    ``posts_until``, per game and time)."""
    ps = post_scores.withColumnsRenamed({"game_id": "_pk", "until": "_pu"})
    same = games[key] == ps["_pk"]
    if posts_until is not None:
        same = same & (games[posts_until] == ps["_pu"])
    g = games.join(ps, same, "left").drop("_pk", "_pu")
    r = review_table.withColumnRenamed("slug", "_slug")
    g = g.withColumn("_slug", X.name_slug("name")).join(r, "_slug", "left").drop("_slug")
    if posts_available:
        reddit = F.coalesce(F.col("reddit_score"), F.lit(0.0))
        volume = F.coalesce(F.col("post_volume"), F.lit(0))
    else:
        reddit = F.lit(None).cast("double")
        volume = F.lit(0)
    meta = F.col("metacritic_score")
    native = S.native_score("hypes", "follows")
    srcs = [reddit, meta, native]
    names = [n for n, _ in C.SOURCE_WEIGHTS]
    weights = [w for _, w in C.SOURCE_WEIGHTS]
    final = X.blend(srcs, weights)
    gate = sentiment_gate()
    if zero_is_missing:
        shown = F.when(final.isNull() | (final == 0), F.lit(C.NEUTRAL_SCORE)).otherwise(final)
    else:
        shown = F.coalesce(final, F.lit(C.NEUTRAL_SCORE))
    return g.withColumns({
        "community_sentiment_score": F.when(gate, shown).otherwise(F.lit(C.NEUTRAL_SCORE)),
        "community_sentiment_label": F.when(gate, X.label(final))
        .otherwise(F.lit(C.NEUTRAL_LABEL)),
        "community_data_volume": F.when(gate & final.isNotNull(), volume).cast("int"),
        "sentiment_source": F.when(gate, X.source_list(srcs, names)),
    }).drop("post_volume", "scored_posts", "total_post_score", "reddit_score",
            "reddit_label", "metacritic_score", "metacritic_label")
