"""Property tests (hypothesis): ranges, permutation invariance, round trips.

Each property evaluates a batch of generated rows in one Spark job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playlens import constants as C
from playlens.functions import metrics as M
from playlens.functions import scores as S
from playlens.operators import dimensions as D

GENRES = list(C.GENRE_WEIGHTS) + ["Unknown_12", "Other"]
SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

games = st.lists(st.tuples(
    st.integers(-800, 800),                       # days to release
    st.one_of(st.none(), st.integers(0, 5000)),   # hypes
    st.one_of(st.none(), st.integers(0, 10 ** 6)),  # follows
    st.one_of(st.none(), st.integers(0, 10 ** 5)),  # rating count
    st.one_of(st.none(), st.floats(0, 100)),      # rating
    st.integers(0, 20), st.integers(0, 20),       # franchise / platform counts
), min_size=1, max_size=40)


@SETTINGS
@given(games)
def test_scores_stay_in_range(spark, rows):
    data = [(d, d >= 0, -d, -d >= 0, h, f, n, r, fr, pl) for d, h, f, n, r, fr, pl in rows]
    df = spark.createDataFrame(
        data, "days_to_release int, is_upcoming boolean, days_since_release int,"
              " is_released boolean, hypes int, follows int, rating_count int,"
              " rating double, franchise_count int, platform_count int")
    out = df.select(M.hype_score().alias("h"), M.longevity_score().alias("l"),
                    S.native_score().alias("n")).collect()
    for h, l, n in out:
        assert h is None or 0.0 <= h <= 100.0
        assert l is None or 0.0 <= l <= 100.0
        assert n is None or 0.0 <= n <= 100.0


@SETTINGS
@given(st.lists(st.lists(st.sampled_from(GENRES), min_size=0, max_size=8),
                min_size=1, max_size=20), st.randoms())
def test_genre_score_permutation_invariant(spark, lists, rnd):
    shuffled = [rnd.sample(g, len(g)) for g in lists]
    df = spark.createDataFrame(list(zip(lists, shuffled)), "a array<string>, b array<string>")
    for a, b in df.select(S.genre_popularity_score("a"), S.genre_popularity_score("b")).collect():
        assert abs(a - b) < 1e-9
        assert 0.0 <= a <= 100.0


@SETTINGS
@given(st.lists(st.lists(st.integers(0, len(C.DIM_GENRES) - 1), max_size=10),
                min_size=1, max_size=20))
def test_translate_then_reverse_is_identity(spark, id_lists):
    dim = dict(enumerate(C.DIM_GENRES))
    df = spark.createDataFrame(list(enumerate(id_lists)), "id int, ids array<int>")
    t = D.translate(df, "ids", dim, "names")
    back = D.reverse_translate(t, "names", dim, "back")
    for r in back.collect():
        assert r["back"] == r["ids"]
