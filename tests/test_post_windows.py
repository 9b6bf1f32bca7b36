"""The month of posts up to each row's own time, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from playlens import constants as C
from playlens.operators import sentiment as sent
from playlens.plans.queries import posts_month_by_row

from .test_stream_ml_plans import SF_SMALL, _plan

DAY, T0 = C.SECONDS_PER_DAY, 1_700_000_000


def _posts(spark, n, ranked):
    r = random.Random(n)
    rows = [(r.choice([1, 1, 1, 2, None]), r.choice(["awesome", "bad", "so so", None]), r.randint(-40, 140),
             T0 + r.randint(0, 90) * DAY + r.choice([0, 0, 7]), i, r.randint(1, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "game_id int, title string, score int, at long, event_id long, rank int")
    df = df.withColumn("posted_at", F.timestamp_seconds("at"))
    return df if ranked else df.drop("rank")


def _rows(spark):
    # ends that fall on posts, on the window's edge, and between; repeated rows; no time; no posts
    times = [(g, T0 + d * DAY + s) for g in (1, 2, 9) for d in (-1, 0, 1, 29, 30, 31, 60, 89, 120, 400) for s in (0, 3)]
    rows = spark.createDataFrame([*times, times[4], (1, None)], "id long, at long")
    return rows.withColumn("own", F.timestamp_seconds("at"))


@pytest.mark.parametrize("ranked", [False, True])
def test_windows_match_brute_force(spark, ranked):
    posts = _posts(spark, 300, ranked).persist()
    if ranked:                                             # ranks must be unique to leave one answer
        posts = posts.withColumn("rank", F.col("event_id").cast("int") * 13 % 307)
    rows = _rows(spark)
    got = {(r.game_id, r.at): (r.post_volume, round(r.reddit_score, 6)) for r in
           sent.posts_before(rows, posts, "own", scored=5).withColumn("at", F.unix_seconds("until")).collect()}
    scored = posts.withColumn("s", sent.X.post_sentiment("title", "score")).collect()
    want = {}
    for g, at in {(r.id, r.at) for r in rows.collect() if r.at is not None}:
        near = [p for p in scored if p.game_id == g and at - 30 * DAY <= p.at <= at]
        near.sort(key=lambda p: p["rank"] if ranked else (p.at, p.event_id))
        if near:
            want[g, at] = (len(near), round((sum(p.s for p in near[:5]) / len(near[:5]) + 1) * 50, 6))
    assert {k: (v, pytest.approx(s, abs=2e-6)) for k, (v, s) in want.items()} == got and len(got) > 20
    assert sent.posts_before(rows, posts.limit(0), "own").count() == 0 == sent.posts_before(rows.limit(0), posts, "own").count()


def test_row_times_decide_within_one_frame(spark):
    posts = _posts(spark, 300, False).where("game_id is not null")
    games = spark.createDataFrame([(1, "Game One", T0 + d * DAY) for d in (10, 60, 500)], "id int, name string, at long").select(
        "*", F.timestamp_seconds("at").alias("own"), F.lit(100).alias("days_to_release"), F.lit(True).alias("is_upcoming"),
        F.lit(None).cast("int").alias("hypes"), F.lit(None).cast("int").alias("follows"))
    reviews = spark.createDataFrame([], "game_id int, slug string, html string")

    def volumes(g):
        out = sent.with_community_sentiment(g, posts, reviews, restrict_sources=True, posts_until="own")
        return {r.at: (r.community_data_volume, r.community_sentiment_score) for r in out.collect()}

    together = volumes(games)
    alone = {}
    for at in together:
        alone |= volumes(games.where(F.col("at") == at))
    assert together == alone and len({v for v, _ in together.values()}) == 3


def test_plan_has_no_pairs(spark):
    plan = _plan(posts_month_by_row(spark, SF_SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
