"""Edge semantics on tiny literal frames (contract rows of SURVEY 1.4)."""

import pytest
from pyspark.sql import functions as F

from playlens import constants as C
from playlens.functions import metrics as M
from playlens.functions import scores as S
from playlens.functions import sentiment as X
from playlens.operators import dimensions as D
from playlens.operators import enrich
from playlens.operators.sentiment import with_community_sentiment
from playlens.sources import stream as st

AS_OF = C.AS_OF_EPOCH
DAY = 86400


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_release_half_day(spark):
    rows = [(AS_OF + DAY // 2,), (AS_OF - DAY // 2,), (AS_OF,), (None,), (0,)]
    got = one(spark, rows, "r long", M.days_since_release(AS_OF, "r"),
              M.days_to_release(AS_OF, "r"), M.is_released(AS_OF, "r"),
              M.is_upcoming(AS_OF, "r"))
    assert got == [(-1, 0, False, True), (0, -1, True, False), (0, 0, True, True),
                   (None, None, False, False), (None, None, False, False)]


@pytest.mark.parametrize("d,factor", [(0, 1.0), (364, 1 - 364 / 365.0), (365, 0.0),
                                      (366, 0.3), (-1, None)])
def test_hype_time_factor(spark, d, factor):
    got = one(spark, [(d, d >= 0, 10, 0, 0)],
              "days_to_release int, is_upcoming boolean, hypes int, follows int, rating_count int",
              M.hype_score())[0][0]
    if factor is None:
        assert got is None
    else:
        assert got == pytest.approx(min(100.0, 20.0 * factor / 10.0))


def test_hype_nulls_are_zero_and_cap(spark):
    got = one(spark, [(10, True, None, None, None), (10, True, 10000, 0, 0)],
              "days_to_release int, is_upcoming boolean, hypes int, follows int, rating_count int",
              M.hype_score())
    assert got[0][0] == 0.0 and got[1][0] == 100.0


@pytest.mark.parametrize("since,age", [(1, 0.5), (365, 0.5), (366, 366 / 365.0 / 10),
                                       (3650 * 2, 1.0)])
def test_longevity_age_step(spark, since, age):
    got = one(spark, [(since, True, 0.0, 0, 0, 0)],
              "days_since_release int, is_released boolean, rating double, rating_count int,"
              " franchise_count int, platform_count int", M.longevity_score())[0][0]
    assert got == pytest.approx(age * 5)


def test_longevity_day_zero_is_null(spark):
    got = one(spark, [(0, True, 80.0, 10, 1, 1)],
              "days_since_release int, is_released boolean, rating double, rating_count int,"
              " franchise_count int, platform_count int", M.longevity_score())
    assert got == [(None,)]


def test_success_levels(spark):
    rows = [(85.0, 600), (85.0, 400), (65.0, 100), (59.0, 1000), (0.0, 10), (50.0, 0),
            (None, 10), (90.0, None)]
    got = [r[0] for r in one(spark, rows, "rating double, rating_count int", M.success_level())]
    assert got == [2, 1, 1, 0, None, None, None, None]


def test_list_scores_empty_null_unknown(spark):
    rows = [([],), (None,), (["Action", "Unknown_12"],), (["Action"] * 3,)]
    got = one(spark, rows, "g array<string>", S.genre_popularity_score("g"),
              S.platform_reach_score("g"))
    assert got[0] == (0.0, 0.0) and got[1] == (0.0, 0.0)
    assert got[2][0] == pytest.approx((1.2 + 0.7) / 2 * 50)
    assert got[3][0] == pytest.approx(60.0)
    assert got[3][1] == pytest.approx(3 * 0.5 * 25)


def test_platform_cap(spark):
    got = one(spark, [(["PlayStation 5"] * 5,)], "p array<string>",
              S.platform_reach_score("p"))[0][0]
    assert got == 100.0


def test_keywords_substring_and_once(spark):
    rows = [("badge collectors",), ("BEST best BEST",), ("great awesome love",), (None,)]
    got = one(spark, rows, "title string",
              X.keyword_hits("title", C.POSITIVE_KEYWORDS),
              X.keyword_hits("title", C.NEGATIVE_KEYWORDS))
    assert got == [(0, 1), (1, 0), (3, 0), (0, 0)]


@pytest.mark.parametrize("score,tier", [(-10, 0.0), (-11, -0.5), (10, 0.0), (11, 0.2),
                                        (50, 0.2), (51, 0.5), (100, 0.5), (101, 1.0)])
def test_vote_tiers(spark, score, tier):
    assert one(spark, [(score,)], "s int", X.vote_sentiment("s"))[0][0] == tier


def test_keyword_sentiment_clamp(spark):
    got = one(spark, [(5, 0), (0, 5), (1, 0), (2, 2)], "p int, n int",
              X.keyword_sentiment("p", "n"))
    assert [g[0] for g in got] == [1.0, -1.0, 0.5, 0.0]


def test_review_extraction(spark):
    pages = [
        '<html><div class="big c-siteReviewScore_user g-text"><span> 7.5 </span></div>',
        '<div class="c-siteReviewScore_user"><p>tbd</p></div><div class="x"><span>1.0</span></div>',
        '<div class="c-siteReviewScore_user"><span>tbd</span></div>',
        '<div class="c-siteReviewScore_user"><b>x</b><span>8</span></div>',
        '<p>nothing</p>',
    ]
    got = one(spark, [(p,) for p in pages], "html string", X.review_user_score("html"))
    assert [g[0] for g in got] == [75.0, None, None, 80.0, None]


def test_review_tags_are_balanced(spark):
    user = '<div class="c-siteReviewScore_user">'
    cases = [
        (user + '<div><div>n</div></div><span>7</span></div>', 70.0),
        (user + '<div>n</div></div><span>7</span>', None),            # behind the element
        (user + '</div>' + user + '<span>7</span></div>', None),      # only the first element counts
        (user + '<span><b>7</b>.<i>5</i></span></div>', 75.0),
        (user + '<span>7<span>.</span>5</span><span>1</span></div>', 75.0),
        (user + '<div><span>7</div>9</div>', 70.0),                   # ends with the div around it
        (user + '<span>7', 70.0),                                     # page ends within
        (user + '<span/><span>7</span></div>', None),
        (user + '<div/><span>7</span></div>', 70.0),
        (user + '<!-- </div><span>1</span> --><span>7</span></div>', 70.0),
        (user + '<!-- <span>7</span></div>', None),                   # comment left open
        ('<script>' + user + '<span>1</span></div></script>' + user + '<span>7</span></div>', 70.0),
        ('<div class="c-siteReviewScore_user-old"><span>7</span></div>', None),
        ("<DIV id='a' class=\"x c-siteReviewScore_user\"><SPAN>7</SPAN></DIV>", 70.0),
        (user + 'a < b <spanner>1</spanner><span> 7 </span></div>', 70.0),
        (user, None), ("", None), (None, None),
        (user + "<div>x</div>" * 50_000 + "<span>7</span></div>", 70.0),
    ]
    got = one(spark, [(p,) for p, _ in cases], "html string", X.review_user_score("html"))
    assert [g[0] for g in got] == [want for _, want in cases]


def test_slug(spark):
    got = one(spark, [("Zelda: Breath of the Wild",)], "n string", X.name_slug("n"))
    assert got == [("zelda-breath-of-the-wild",)]


def _game(spark, rows):
    return spark.createDataFrame(
        rows, "id int, name string, hypes int, follows int, days_to_release int,"
              " is_upcoming boolean")


def test_community_gate_zero_and_no_fanout(spark):
    games = _game(spark, [(1, "A", 0, 0, 10, True), (1, "A", 0, 0, 10, True),
                          (2, "B", 10, 10, 0, True), (3, "C", 50, 500, 400, True)])
    posts = spark.createDataFrame([], "game_id int, title string, score int, rank int,"
                                      " posted_at timestamp")
    reviews = spark.createDataFrame([], "game_id int, slug string, html string")
    out = with_community_sentiment(games, posts, reviews).orderBy("id").collect()
    assert len(out) == 4  # duplicate ids stay two rows, no n x n fan-out
    # id 1: reddit 0.0 (answered, empty) + native 0.0 -> 0.0 -> shown as 50.0, label kept
    assert out[0]["community_sentiment_score"] == 50.0
    assert out[0]["community_sentiment_label"] == "negative"
    assert out[0]["sentiment_source"] == "reddit+igdb"
    assert out[0]["community_data_volume"] == 0
    # day 0 and beyond a year: neutral defaults
    for r in out[2:]:
        assert (r["community_sentiment_score"], r["community_sentiment_label"],
                r["community_data_volume"], r["sentiment_source"]) == (50.0, "neutral", None, None)


def test_blend_renormalises(spark):
    got = one(spark, [(80.0, None, 20.0)], "r double, m double, n double",
              X.blend([F.col("r"), F.col("m"), F.col("n")], [0.4, 0.3, 0.3]))[0][0]
    assert got == pytest.approx((80 * 0.4 + 20 * 0.3) / 0.7)


def test_native_score(spark):
    got = one(spark, [(100, 1000), (1000, 100000), (None, 5)], "h int, f int",
              S.native_score("h", "f"))
    assert [g[0] for g in got] == [50.0, 100.0, None]


def test_confidence(spark):
    got = one(spark, [(1, 1, 1, 1, 1, 1, 50), (0, 0, 0, 0, 0, 0, None), (1, 0, 0, 0, 0, 0, 5)],
              "hypes int, follows int, rating_count int, franchise_count int,"
              " platform_count int, genre_count int, community_data_volume int",
              S.prediction_confidence())
    assert [round(g[0], 6) for g in got] == [115.0, 0.0, round((1 / 6 + 0.05) * 100, 6)]


def test_translate_and_reverse(spark):
    dim = spark.createDataFrame([(0, "Zero"), (1, "One"), (2, "One")], "id int, name string")
    df = spark.createDataFrame([(1, [2, 0, 7]), (2, None), (3, [])], "id int, ids array<int>")
    t = D.translate(df, "ids", dim, "names")
    got = {r["id"]: r["names"] for r in t.collect()}
    assert got == {1: ["One", "Zero", "Unknown_7"], 2: [], 3: []}
    tj = D.translate(df, "ids", dim, "names", strategy="join")
    assert {r["id"]: r["names"] for r in tj.collect()} == got
    back = D.reverse_translate(t, "names", dim, "back")
    # first match is the lowest id; id 0 kept; unknown names dropped
    assert {r["id"]: r["back"] for r in back.collect()} == {1: [1, 0], 2: [], 3: []}


def test_decode_quarantines_malformed(spark):
    env = spark.createDataFrame(
        [("t", '{"id": 1, "name": "A"}'), ("t", "not json"), ("t", ""), ("t", None),
         ("t", '{"id": 2')], "timestamp string, value string")
    ok = st.decode(env).collect()
    assert [r["id"] for r in ok] == [1]
    bad = st.quarantine(env).orderBy("reason").collect()
    assert sorted(r["reason"] for r in bad) == ["empty", "malformed", "malformed", "null"]


def test_fill_defaults_only_present(spark):
    df = spark.createDataFrame([(None, None)], "hypes int, other int")
    got = enrich.fill_defaults(df).collect()[0]
    assert got["hypes"] == 0 and got["other"] is None


def test_restrict_sources_same_result(spark):
    from playlens.plans import queries as Q
    from playlens.sources import fixtures as fx
    from .conftest import SF_SMALL
    g = Q.filled_games(spark, SF_SMALL).where("id % 7 = 3")
    posts, reviews = fx.posts(spark, SF_SMALL), fx.reviews(spark, SF_SMALL)
    cols = ["id", "community_sentiment_score", "community_sentiment_label",
            "community_data_volume", "sentiment_source"]
    a = with_community_sentiment(g, posts, reviews).select(*cols).collect()
    b = with_community_sentiment(g, posts, reviews, restrict_sources=True).select(*cols).collect()
    assert sorted(a) == sorted(b)


def test_int_in_double_field_decodes(spark):
    env = spark.createDataFrame([("t", '{"id": 1, "rating": 80, "hype_score": 5}')],
                                "timestamp string, value string")
    r = st.decode(env).collect()[0]
    assert r["rating"] == 80.0 and r["hype_score"] == 5.0


def test_posts_unavailable_drops_source(spark):
    games = _game(spark, [(1, "A", 100, 1000, 10, True)])
    posts = spark.createDataFrame([], "game_id int, title string, score int, rank int,"
                                      " posted_at timestamp")
    reviews = spark.createDataFrame([], "game_id int, slug string, html string")
    on = with_community_sentiment(games, posts, reviews).collect()[0]
    off = with_community_sentiment(games, posts, reviews, posts_available=False).collect()[0]
    # answered but empty: 0.0 enters the mean; unavailable: only the native score
    assert on["community_sentiment_score"] == pytest.approx(50.0 * 0.3 / 0.7)
    assert on["sentiment_source"] == "reddit+igdb"
    assert off["community_sentiment_score"] == pytest.approx(50.0)
    assert off["sentiment_source"] == "igdb"
    assert off["community_data_volume"] == 0


def test_strategies_agree_on_repeats_and_nulls(spark):
    rows = [(1, [0], ["A"]), (1, [1, 9, None], ["Z", None, "B"]), (None, [2, 2], []), (None, None, None), (2, [], ["A", "A"])]
    df = spark.createDataFrame(rows, "key int, ids array<int>, names array<string>")
    dim = spark.createDataFrame([(0, "A2"), (0, "A"), (1, "B"), (2, "Cc"), (3, "A"), (None, "n"), (4, None)], "id int, name string")
    out = {}
    for how in ("map", "join"):
        t = D.reverse_translate(D.translate(df, "ids", dim, "to_names", how), "names", dim, "to_ids", how)
        out[how] = sorted(map(tuple, t.select("key", "ids", "to_names", "names", "to_ids").collect()), key=str)
    assert out["map"] == out["join"]
    got = {str(r[1]): (r[2], r[4]) for r in out["join"]}
    assert got["[0]"] == (["A"], [0])
    assert got["[1, 9, None]"] == (["B", "Unknown_9", None], [1])
    assert got["[2, 2]"] == (["Cc", "Cc"], []) and got["None"] == ([], []) and got["[]"] == ([], [0, 0])


def test_large_dimensions_change_speed_only(spark, monkeypatch):
    df = spark.createDataFrame([([5, 1999, 7000],)], "ids array<int>")
    big = {i: f"n{i:05d}" for i in range(2000)}
    assert len(big) > D.MAP_MAX_ROWS
    t = D.reverse_translate(D.translate(df, "ids", big, "names"), "names", big, "back").collect()[0]
    assert t["names"] == ["n00005", "n01999", "Unknown_7000"] and t["back"] == [5, 1999]


def test_month_window_comes_before_the_first_posts(spark):
    """60 old posts and 60 strongly positive recent ones: only recent ones count."""
    from playlens.operators.sentiment import posts_last_month
    rows = [(1, "meh", 0, f"2023-06-01 00:{i:02d}:00", i) for i in range(60)]
    rows += [(1, "amazing epic best", 500, f"2024-01-10 00:{i:02d}:00", 100 + i) for i in range(60)]
    posts = spark.createDataFrame(rows, "game_id int, title string, score int, posted_at string, event_id int") \
        .withColumn("posted_at", F.col("posted_at").cast("timestamp"))
    games = spark.createDataFrame([(1,), (2,)], "id int")
    got = {r["id"]: r for r in posts_last_month(games, posts, "2024-01-20 00:00:00").collect()}
    assert got[1]["month_post_volume"] == 60 and got[1]["month_reddit_score"] == pytest.approx(100.0)
    assert got[2]["month_post_volume"] == 0 and got[2]["month_reddit_score"] == 0.0


def test_bulk_documents_default_hypes_and_follows(spark):
    from playlens.plans import queries as Q
    from .conftest import SF_SMALL
    d = Q.bulk_metrics(spark, SF_SMALL)
    assert d.where("hypes is null or follows is null").count() == 0
    assert Q.raw_games(spark, SF_SMALL).where("hypes is null").count() > 0


def test_shared_dir_honours_the_context(spark):
    from playlens.session import shared_dir
    first = shared_dir(spark, "x")
    assert first == shared_dir(spark, "x") and spark.sparkContext.getCheckpointDir()
