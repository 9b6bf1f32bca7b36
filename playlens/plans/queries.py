"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query runs the library operators over the whole driver tables (through
the fixture mapping) and ends in a flat projection whose column names match
its SQL oracle in ``plans/oracle_queries.py``.  Arrays are shown as
'|'-joined text and doubles rounded to 6 places so both engines print equal
values.
"""

from __future__ import annotations

import functools
import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scores as S
from ..functions import sentiment as X
from ..functions.sentiment import memo_key
from ..functions.sql_functions import register_sql_functions
from ..operators import dimensions as dims_op
from ..operators import enrich, ml
from ..operators import model_values as mv
from ..operators import selection as sel
from ..operators import sentiment as sent
from ..operators.memo import ttl_memo
from ..schemas import HISTORY, conform
from ..session import pin_semantics, shared_dir
from ..sinks import documents as docs_op
from ..sinks import history as hist_op
from ..sources import fixtures as fx
from ..sources import stream as st
from ..sources.tables import read_table
from ..streaming.pipeline import start_enrichment
from . import jobs
from .enrichment import enrich_documents, score_records

AS_OF = C.AS_OF_EPOCH
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    """Register a query; it pins the session settings its semantics need
    (UTC day arithmetic, ANSI casts) on whatever session it is given."""

    @functools.wraps(fn)
    def run(spark, sf):
        pin_semantics(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return fn


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def joined(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(col.cast("array<string>"), "|")


# ---------------------------------------------------------------- base frames

def raw_games(spark, sf):
    return fx.games(spark, sf)


def stream_games(spark, sf):
    """Topic records as the crawler emits them (translated + metrics)."""
    return enrich.crawl_transform(raw_games(spark, sf), fx.dimension_maps(), AS_OF)


def filled_games(spark, sf):
    """Stream records after list scores and the null fill."""
    return enrich.fill_defaults(enrich.with_list_scores(stream_games(spark, sf)))


def community_games(spark, sf):
    return sent.with_community_sentiment(
        filled_games(spark, sf), fx.posts(spark, sf), fx.reviews(spark, sf),
        posts_as_of=C.POSTS_AS_OF)


# ---------------------------------------------------------------- metrics

@register
def release_timing(spark, sf):
    g = enrich.with_release_timing(raw_games(spark, sf), AS_OF)
    return g.select("id", "release_date_formatted", "days_since_release",
                    "days_to_release", "is_released", "is_upcoming")


@register
def hype_score(spark, sf):
    g = stream_games(spark, sf)
    return g.select("id", "days_to_release", r6("hype_score").alias("hype_score"))


@register
def longevity_score(spark, sf):
    g = stream_games(spark, sf)
    return g.select("id", "franchise_count", "platform_count",
                    r6("longevity_score").alias("longevity_score"))


@register
def success_level(spark, sf):
    return stream_games(spark, sf).select("id", "success_level")


@register
def array_counts(spark, sf):
    g = stream_games(spark, sf)
    return g.select("id", "franchise_count", "platform_count", "genre_count",
                    "company_count", "video_count", "screenshot_count",
                    "website_count", "marketing_intensity", "has_multiplayer",
                    "has_expansions")


# ---------------------------------------------------------------- dimensions

def _translated(g):
    return g.select("id", joined("genre_ids").alias("genre_ids"),
                    joined("genres").alias("genres"),
                    joined("platform_ids").alias("platform_ids"),
                    joined("platforms").alias("platforms"),
                    joined("game_modes").alias("game_modes"),
                    joined("themes").alias("themes"),
                    joined("player_perspectives").alias("player_perspectives"))


@register
def translate_ids(spark, sf):
    return _translated(dims_op.translate_game(raw_games(spark, sf), fx.dimension_maps()))


@register
def translate_ids_join(spark, sf):
    return _translated(dims_op.translate_game(raw_games(spark, sf), fx.dimensions(spark),
                                              strategy="join"))


def _mixed(spark, sf, dims, strategy):
    t = dims_op.translate_game(fx.mixed_games(raw_games(spark, sf)), dims, strategy)
    return t.select("id", *[joined(c).alias(c) for pair in dims_op.TRANSLATED.values() for c in pair])


@register
def translate_mixed_map(spark, sf):
    return _mixed(spark, sf, fx.dimension_maps(), "map")


@register
def translate_mixed_join(spark, sf):
    return _mixed(spark, sf, fx.dimensions(spark), "join")


@register
def crawl_mixed(spark, sf):
    """The crawl of games with mixed arrays: counts and list fields of the messages."""
    m = jobs.crawl(fx.mixed_games(raw_games(spark, sf)), fx.dimension_maps(), AS_OF)
    v = F.col("value")
    return m.select(F.col("key").cast("int").alias("id"), F.get_json_object(v, "$.genre_count").cast("int").alias("genre_count"),
                    F.get_json_object(v, "$.platforms").alias("j_platforms"),
                    F.get_json_object(v, "$.platform_ids").alias("j_platform_ids"))


def _repeating(spark, sf):
    """Id arrays under keys that repeat and are null for some, and a dimension
    that lists each id twice (the second name is later in order)."""
    g = raw_games(spark, sf).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 100).alias("key"), "id", "genres")
    d = fx.dimension(spark, "genres")
    return g, d.unionByName(d.select("id", F.concat(F.lit("~"), "name").alias("name")))


def _by(strategy):
    def query(spark, sf):
        g, d = _repeating(spark, sf)
        t = dims_op.translate(g, "genres", d, "names", strategy)
        t = dims_op.reverse_translate(t, "names", d, "back", strategy)
        return t.select("id", "key", joined("names").alias("names"), joined("back").alias("back"))

    query.__name__ = f"translate_repeats_{strategy}"
    return register(query)


translate_repeats_map, translate_repeats_join = _by("map"), _by("join")


@register
def reverse_translate(spark, sf):
    d = fx.dimension_maps()
    g = dims_op.translate_game(raw_games(spark, sf), d)
    g = dims_op.reverse_translate(g, "genres", d["genres"], "genre_ids_back")
    g = dims_op.reverse_translate(g, "platforms", d["platforms"], "platform_ids_back")
    return g.select("id", joined("genre_ids_back").alias("genre_ids_back"),
                    joined("platform_ids_back").alias("platform_ids_back"))


@register
def genre_popularity(spark, sf):
    g = enrich.with_list_scores(stream_games(spark, sf))
    return g.select("id", r6("genre_popularity_score").alias("genre_popularity_score"))


@register
def platform_reach(spark, sf):
    g = enrich.with_list_scores(stream_games(spark, sf))
    return g.select("id", r6("platform_reach_score").alias("platform_reach_score"))


# ---------------------------------------------------------------- sentiment

@register
def native_score(spark, sf):
    g = raw_games(spark, sf)
    return g.select("id", r6(S.native_score("hypes", "follows")).alias("native_score"))


@register
def post_sentiment(spark, sf):
    p = sent.post_sentiment(fx.posts(spark, sf))
    return p.select("game_id", "post_volume", "scored_posts", "total_post_score",
                    r6("reddit_score").alias("reddit_score"), "reddit_label")


@register
def review_score(spark, sf):
    g = sent.with_review_scores(raw_games(spark, sf).select("id", "name"),
                                fx.reviews(spark, sf))
    return g.select("id", r6("metacritic_score").alias("metacritic_score"),
                    "metacritic_label")


@register
def review_score_nested(spark, sf):
    """User scores of pages whose score block holds nested tags (one of them over 10 MB)."""
    g = fx.nested_reviews(spark, sf).select("page_id", X.review_user_score().alias("score"))
    return g.select("page_id", r6("score").alias("user_score"),
                    X.review_label("score").alias("user_label"))


@register
def community_sentiment(spark, sf):
    g = community_games(spark, sf)
    return g.select("id", r6("community_sentiment_score").alias("community_sentiment_score"),
                    "community_sentiment_label", "community_data_volume",
                    "sentiment_source")


@register
def posts_last_month(spark, sf):
    g = sent.posts_last_month(raw_games(spark, sf), fx.posts(spark, sf), C.POSTS_AS_OF)
    return g.select("id", "month_post_volume",
                    r6("month_reddit_score").alias("month_reddit_score"))


@register
def posts_month_by_row(spark, sf):
    """Each post as a record with its own time: the month of posts up to it."""
    posts = fx.posts(spark, sf)
    rows = posts.select("event_id", "game_id", F.col("posted_at").alias("until"))
    return rows.join(sent.posts_before(rows, posts, "until", "game_id"), ["game_id", "until"], "left").select(
        "event_id", "game_id", F.coalesce("post_volume", F.lit(0)).alias("month_post_volume"),
        r6(F.coalesce("reddit_score", F.lit(0.0))).alias("month_reddit_score"))


# ---------------------------------------------------------------- selections


RECENT_BOUND = AS_OF - C.RECENT_WINDOW_DAYS * C.SECONDS_PER_DAY
# fixture releases span 1995..2001, so the page bound sits inside that range
PAGE_BOUND = 883612800  # 1998-01-01 00:00:00 UTC
PAGE_SIZE = C.BULK_PAGE_SIZE


def recent_batch(spark, sf):
    """Crawl batch: released in the last 60 days or later, top 100 by hypes,
    then transformed.  The ids are ranked first (from orders alone), so only
    their lines are aggregated."""
    top = sel.top_ids(sel.recent_window(raw_games(spark, sf), AS_OF))
    return enrich.crawl_transform(fx.games(spark, sf, top), fx.dimension_maps(), AS_OF)


@register
def upcoming_window(spark, sf):
    g = sel.upcoming_window(stream_games(spark, sf))
    return g.select("id", "days_to_release", r6("hype_score").alias("hype_score"))


@register
def recent_top_hyped(spark, sf):
    g = recent_batch(spark, sf)
    return g.select("id", "name", "hypes", "first_release_date", "days_to_release",
                    "is_upcoming", r6("hype_score").alias("hype_score"))


@register
def release_split(spark, sf):
    return sel.release_split_counts(stream_games(spark, sf))


@register
def split_preview(spark, sf):
    p = sel.split_preview(recent_batch(spark, sf))
    return p.withColumn("metric", r6("metric"))


@register
def release_page(spark, sf):
    p = sel.release_page(raw_games(spark, sf), PAGE_BOUND, 1, PAGE_SIZE)
    return p.select("id", "name", "first_release_date")


# keyset page: the page after 1999-01-01 00:00:00 UTC (id 0)
KEYSET_AFTER = (915148800, 0)


@register
def release_page_keyset(spark, sf):
    p = sel.release_page_after(raw_games(spark, sf), PAGE_BOUND, KEYSET_AFTER, PAGE_SIZE)
    return p.select("id", "name", "first_release_date")


@register
def release_pages(spark, sf):
    p = sel.release_pages(raw_games(spark, sf), PAGE_BOUND, PAGE_SIZE)
    return p.select("id", "first_release_date", "page", "position")


# ---------------------------------------------------------------- messages


DECODED_COLS = ["timestamp", "id", "name", "rating", "rating_count", "hypes",
                "follows", "first_release_date", "total_rating", "aggregated_rating",
                "days_since_release", "days_to_release", "is_released",
                "is_upcoming", "franchise_count", "platform_count", "genre_count",
                "hype_score", "longevity_score", "success_level"]
DECODED_ARRAYS = ["franchises", "genres", "platforms", "genre_ids", "platform_ids",
                  "game_modes", "themes"]
ROUNDED = {"rating", "total_rating", "aggregated_rating", "hype_score", "longevity_score"}


def envelope_of(spark, sf):
    return fx.envelope(stream_games(spark, sf), AS_OF)


@register
def decode_games(spark, sf):
    g = st.decode(envelope_of(spark, sf))
    cols = [r6(c).alias(c) if c in ROUNDED else F.col(c) for c in DECODED_COLS]
    return g.select(*cols, *[joined(a).alias(a) for a in DECODED_ARRAYS])


@register
def encode_games(spark, sf):
    m = docs_op.encode(stream_games(spark, sf))
    v = F.col("value")
    return m.select(
        F.col("key").cast("int").alias("id"),
        F.get_json_object(v, "$.name").alias("j_name"),
        F.get_json_object(v, "$.hypes").alias("j_hypes"),
        F.get_json_object(v, "$.genre_ids").alias("j_genre_ids"),
        F.get_json_object(v, "$.genres").alias("j_genres"),
        F.get_json_object(v, "$.is_upcoming").alias("j_is_upcoming"),
        F.get_json_object(v, "$.days_to_release").alias("j_days_to_release"))


@register
def load_stats(spark, sf):
    return docs_op.load_stats(st.parse(envelope_of(spark, sf)), st.decode_ok())


@register
def fill_defaults(spark, sf):
    g = enrich.fill_defaults(stream_games(spark, sf))
    return g.select("id", "hypes", "follows", "rating_count", "franchise_count",
                    "platform_count", "genre_count", r6("total_rating").alias("total_rating"),
                    r6("aggregated_rating").alias("aggregated_rating"))


def scored(spark, sf):
    return score_records(stream_games(spark, sf), fx.posts(spark, sf), fx.reviews(spark, sf),
                         posts_as_of=C.POSTS_AS_OF)


@register
def confidence(spark, sf):
    g = scored(spark, sf)
    return g.select("id", "community_data_volume",
                    r6("prediction_confidence").alias("prediction_confidence"))


@register
def success_score(spark, sf):
    g = stream_games(spark, sf)
    return g.select("id", "success_level",
                    S.success_score("success_level").alias("success_score"))


def documents_of(spark, sf, batch_id=0):
    return enrich_documents(stream_games(spark, sf), fx.posts(spark, sf),
                            fx.reviews(spark, sf), batch_id, AS_OF, posts_as_of=C.POSTS_AS_OF)


DOC_ROUNDED = ["rating", "total_rating", "aggregated_rating", "genre_popularity_score",
               "platform_reach_score", "hype_score", "longevity_score",
               "community_sentiment_score", "prediction_confidence"]
DOC_PLAIN = ["game_id", "name", "rating_count", "hypes", "follows", "release_date",
             "days_to_release", "days_since_release", "is_released", "is_upcoming",
             "franchise_count", "platform_count", "genre_count", "success_level",
             "community_sentiment_label", "community_data_volume", "sentiment_source",
             "predicted_rating", "predicted_rating_count", "predicted_longevity",
             "predicted_success_class", "predicted_success_score", "batch_id",
             "processed_timestamp", "ingestion_time"]
DOC_ARRAYS = ["genres", "platforms", "game_modes", "themes", "player_perspectives"]


@register
def document_projection(spark, sf):
    d = documents_of(spark, sf, batch_id=7)
    return d.select(*DOC_PLAIN, *[r6(c).alias(c) for c in DOC_ROUNDED],
                    *[joined(a).alias(a) for a in DOC_ARRAYS])


@register
def doc_keys(spark, sf):
    d = documents_of(spark, sf, batch_id=7)
    return d.select("game_id", "batch_id", docs_op.doc_key().alias("doc_id"))


def history_of(spark, sf):
    """History as training reads it: conformed + filled."""
    h = conform(documents_of(spark, sf), HISTORY)
    return h.na.fill(C.HISTORY_FILLS)


def _stored(spark, sf, *loads):
    """Loads of documents folded into a stored history, one after the other; the newest of each game."""
    path = shared_dir(spark, f"history/{uuid.uuid4().hex}")
    for version, docs in enumerate(loads):
        hist_op.fold_documents(docs, path, version)
    return hist_op.read_newest(spark, path)


def _history_row(h):
    cols = []
    for f in HISTORY.fields:
        if f.name in HIST_ROUNDED:
            cols.append(r6(f.name).alias(f.name))
        elif f.dataType.typeName() == "array":
            cols.append(joined(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return h.select(*cols)


HIST_ROUNDED = ["rating", "total_rating", "aggregated_rating", "hype_score",
                "longevity_score", "community_sentiment_score"]


@register
def history_scan(spark, sf):
    """The stored history after a bulk load a day ago and the stream's documents since: the stream's are newer."""
    bulk = enrich.bulk_document(raw_games(spark, sf), fx.dimension_maps(), AS_OF - 86400)
    return _history_row(_stored(spark, sf, bulk, documents_of(spark, sf)))


@register
def history_newest(spark, sf):
    """The stored history of three loads: a bulk load, the stream's documents of two games in three since,
    and a later bulk load of every fourth game."""
    def bulk(games, at):
        return enrich.bulk_document(games, fx.dimension_maps(), AS_OF).withColumn("processed_timestamp", F.lit(at).cast("long"))

    g = raw_games(spark, sf)
    return _history_row(_stored(spark, sf, bulk(g, AS_OF - 1), documents_of(spark, sf).where("game_id % 3 > 0"),
                                bulk(g.where("id % 4 = 0"), AS_OF + 1)))


@register
def bulk_metrics(spark, sf):
    d = enrich.bulk_document(raw_games(spark, sf), fx.dimension_maps(), AS_OF)
    return d.select(
        "game_id", "name", "release_date_formatted", "days_since_release",
        "days_to_release", "is_released", "is_upcoming", "franchise_count",
        "platform_count", "genre_count", "company_count", "video_count",
        "screenshot_count", "website_count", "marketing_intensity",
        r6("hype_score").alias("hype_score"), r6("longevity_score").alias("longevity_score"),
        "success_level", "has_multiplayer", "has_expansions", "release_date",
        "ingestion_time", "processed_timestamp", "hypes", "follows", "category", "status",
        "rating_count", "total_rating_count", "aggregated_rating_count",
        r6("rating").alias("rating"), r6("total_rating").alias("total_rating"),
        r6("aggregated_rating").alias("aggregated_rating"), "doc_id",
        *[joined(c).alias(c) for c in enrich.BULK_ARRAYS
          if c not in ("genre_ids", "genres", "expansions", "videos")],
        joined("genre_ids").alias("genre_ids"), joined("genres").alias("genres"),
        joined("expansions").alias("expansions"), joined("videos").alias("videos"))


# ---------------------------------------------------------------- training



@register
def train_counts(spark, sf):
    t = ml.training_frame(history_of(spark, sf))
    aggs = [F.count(F.lit(1)).cast("long").alias("total")]
    for name in ml.DEFAULT_MODELS:
        aggs.append(F.count_if(ml.SPEC_BY_NAME[name].row_filter()).cast("long")
                    .alias(f"n_{name}"))
    return t.agg(*aggs)


@register
def feature_rows(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    g = stream_games(spark, sf)
    asm = VectorAssembler(inputCols=C.EXTENDED_FEATURES, outputCol="features",
                          handleInvalid="skip")
    v = asm.transform(g)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return v.select("id", r6(total).alias("feature_sum"))


# ---------------------------------------------------------------- predictions
# (rows-only checks: model outputs have no SQL oracle)

_MODELS: dict = {}


def trained(spark, sf, names):
    """Models fitted on the history of ``sf``, kept per model for the process
    (one training pass fits every model not fitted yet)."""
    app = spark.sparkContext.applicationId  # models live in one JVM session
    missing = [n for n in names if (app, sf, n) not in _MODELS]
    if missing:
        fitted = ml.train_models(history_of(spark, sf), missing)
        for n in missing:
            _MODELS[(app, sf, n)] = fitted.get(n)
    return {n: _MODELS[(app, sf, n)] for n in names if _MODELS[(app, sf, n)] is not None}


def predicted(spark, sf, names):
    return score_records(stream_games(spark, sf), fx.posts(spark, sf),
                         fx.reviews(spark, sf), trained(spark, sf, names),
                         posts_as_of=C.POSTS_AS_OF)


@register
def predict_rating(spark, sf):
    return predicted(spark, sf, ["rating"]).select("id", "predicted_rating")


@register
def predict_rating_base(spark, sf):
    return predicted(spark, sf, ["rating_base"]).select("id", "predicted_rating")


@register
def predict_rating_count(spark, sf):
    return predicted(spark, sf, ["rating_count"]).select("id", "predicted_rating_count")


@register
def predict_longevity(spark, sf):
    return predicted(spark, sf, ["longevity"]).select("id", "predicted_longevity")


@register
def predict_success(spark, sf):
    return predicted(spark, sf, ["success"]).select(
        "id", "predicted_success_class", "predicted_success_score")


@register
def predict_all(spark, sf):
    g = predicted(spark, sf, ml.DEFAULT_MODELS)
    return docs_op.document(g, 0, AS_OF).select(
        "game_id", "predicted_rating", "predicted_rating_count", "predicted_longevity",
        "predicted_success_class", "predicted_success_score", "prediction_confidence")


@register
def predict_rating_linear(spark, sf):
    models = trained(spark, sf, ["rating_linear"])
    g = scored(spark, sf)
    if "rating_linear" in models:
        g = ml._apply(g, ml.SPEC_BY_NAME["rating_linear"], models["rating_linear"])
    else:
        g = g.withColumn("predicted_rating_linear", F.lit(None).cast("double"))
    return g.select("id", "predicted_rating_linear")


@register
def linear_residuals(spark, sf):
    """Least squares by value: over the training rows the residuals of the
    linear model sum to 0, alone and against each feature (normal equations)."""
    spec = ml.SPEC_BY_NAME["rating_linear"]
    rows = ml.training_frame(history_of(spark, sf)).where(spec.row_filter())
    model = trained(spark, sf, ["rating_linear"])["rating_linear"]
    g = ml._apply(rows, spec, model).withColumn("_r", F.col(spec.label) - F.col(spec.prediction))
    size = F.sum(F.abs(F.col(spec.label)))
    sums = {"bias": F.sum("_r") / size, **{
        c: F.sum(F.col("_r") * F.col(c)) / (size * F.greatest(F.max(F.abs(F.col(c))), F.lit(1.0))) for c in spec.features}}
    return g.agg(*[F.abs(F.round(v, 6)).alias(f"residual_{c}") for c, v in sums.items()])


@register
def forest_ranges(spark, sf):
    """Forests predict means of labels: how many predictions are missing or
    outside the range of the training labels (none)."""
    history = ml.training_frame(history_of(spark, sf))
    specs = [ml.SPEC_BY_NAME[n] for n in ("rating_count", "longevity")]
    bounds = history.agg(*[f(F.when(s.row_filter(), F.col(s.label))).alias(f"{n}_{s.name}")
                           for s in specs for n, f in (("lo", F.min), ("hi", F.max))]).first()
    g = predicted(spark, sf, [s.name for s in specs])

    def outside(s):
        p = F.col(s.prediction)
        return p.isNull() | (p < F.lit(bounds[f"lo_{s.name}"]) - 1e-6) | (p > F.lit(bounds[f"hi_{s.name}"]) + 1e-6)

    return g.agg(*[F.count_if(outside(s)).cast("long").alias(f"outside_{s.name}") for s in specs])


def _differ(a, b):
    """Null on one side, or apart by more than rounding."""
    a, b = F.col(a), F.col(b)
    return ~F.coalesce(F.abs(a - b) <= F.greatest(F.abs(a), F.lit(1.0)) * 1e-9, F.lit(False))


@register
def tree_values(spark, sf):
    """Tree models by value: rows scored, and rows whose prediction differs from
    the model's exported nodes walked by column expressions (none)."""
    names = ["rating", "rating_base", "rating_count", "longevity"]
    models = trained(spark, sf, ml.DEFAULT_MODELS)
    g = ml.training_frame(history_of(spark, sf))
    counts = []
    for name in names:          # columns of one frame: a single pass
        spec = ml.SPEC_BY_NAME[name]
        g = mv.score_trees(ml._apply(g, spec, models[name]), mv.tree_nodes(spark, models[name]),
                           spec.features, f"{name}_by_nodes", mean=spec.kind == "rf")
        counts.append(F.struct(F.lit(name).alias("model"), F.count(spec.prediction).alias("scored"),
                               F.count_if(_differ(spec.prediction, f"{name}_by_nodes")).alias("differing")))
    return g.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


@register
def tree_leaves(spark, sf):
    """Regression trees by value: the first boosted tree's leaves hold the count and
    mean of the labels of the training rows that reach them; how many do not (none)."""
    out = None
    for name in ("rating", "rating_base"):
        spec, model = ml.SPEC_BY_NAME[name], trained(spark, sf, ml.DEFAULT_MODELS)[name]
        rows = ml.training_frame(history_of(spark, sf)).where(spec.row_filter())
        g = mv.leaf_means(rows, mv.tree_nodes(spark, model), spec.features, spec.label)
        one = g.agg(F.lit(name).alias("model"), F.sum("seen").alias("reached"),
                    F.count_if(_differ("value", "mean") | ~F.col("rows").eqNullSafe(F.col("seen")))
                    .alias("differing"))
        out = one if out is None else out.unionByName(one)
    return out


@register
def logistic_values(spark, sf):
    """The logistic model by value: rows whose class or probability differs from the
    softmax of its coefficients (none); training rows, and the distance of their mean
    log loss from the objective at which the fit stopped (0)."""
    from pyspark.ml.functions import vector_to_array
    spec, model = ml.SPEC_BY_NAME["success"], trained(spark, sf, ml.DEFAULT_MODELS)["success"]
    fitted = model.stages[-1]
    rows = ml.training_frame(history_of(spark, sf))
    g = model.transform(rows).select("*", vector_to_array("probability").alias("p"),
                                     mv.softmax(fitted, spec.features).alias("by_hand"))
    apart = F.aggregate(F.zip_with("p", "by_hand", lambda a, b: F.abs(a - b)), F.lit(0.0),
                        lambda most, d: F.greatest(most, d))
    class_apart = F.get("by_hand", F.col(spec.prediction).cast("int")) < F.array_max("by_hand") - 1e-9
    loss = F.when(spec.row_filter(), -F.ln(F.get("by_hand", F.col(spec.label).cast("int"))))
    return g.agg(F.count("*").alias("scored"),
                 F.count_if(F.coalesce((apart > 1e-9) | class_apart, F.lit(True))).alias("differing"),
                 F.count(loss).alias("trained_on"),
                 F.abs(F.round(F.avg(loss) - fitted.summary.objectiveHistory[-1], 6)).alias("loss_apart"))


# ---------------------------------------------------------------- TTL memo


MEMO_KEYS = 5


def memo_events(spark, sf):
    """Events as memo requests: key ``user_id % 5``, whole epoch seconds,
    the event value as the computed score."""
    ev = read_table(spark, sf, "events")
    return ev.select((F.col("user_id") % MEMO_KEYS).cast("int").alias("k"),
                     F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"),
                     "event_id", F.col("value").alias("score"))


@register
def sentiment_memo(spark, sf):
    m = ttl_memo(memo_events(spark, sf), "k", "t", "event_id", "score", C.MEMO_TTL_SECONDS)
    return m.select("event_id", "k", "t", "memo_at", r6("memo_value").alias("memo_score"))


@register
def sentiment_memo_by_key(spark, sf):
    """Memo requests keyed as the stream keys them (X23: name and week of the
    days to release), of the games inside the sentiment gate."""
    games = stream_games(spark, sf).where(sent.sentiment_gate()).select(
        "id", memo_key("name", "days_to_release").alias("k"))
    events = read_table(spark, sf, "events").select(
        F.col("user_id").cast("int").alias("id"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"),
        "event_id", F.col("value").alias("score"))
    m = ttl_memo(events.join(games, "id").drop("id"), "k", "t", "event_id", "score", C.MEMO_TTL_SECONDS)
    return m.select("event_id", "k", "t", "memo_at", r6("memo_value").alias("memo_score"))


# ---------------------------------------------------------------- streaming
# (a stream run through the file source and foreachBatch)


@register
def stream_roundtrip(spark, sf):
    """Envelope files -> file stream -> foreachBatch enrichment -> idempotent
    documents sink; returns the sink read back."""
    base = shared_dir(spark, f"stream_roundtrip/{uuid.uuid4().hex}")
    # as many message files as the input has partitions, a bounded number per trigger; gzip, as
    # the field names and nulls of each message make most of its JSON
    envelope_of(spark, sf).write.mode("overwrite").option("compression", "gzip").json(base + "/in")
    q = start_enrichment(st.file_stream(spark, base + "/in", max_files_per_trigger=64),
                         fx.posts(spark, sf), fx.reviews(spark, sf), base + "/out",
                         base + "/checkpoint", as_of_fn=lambda _b: AS_OF,
                         available_now=True, posts_as_of=C.POSTS_AS_OF)
    q.awaitTermination()
    return spark.read.parquet(base + "/out").select(
        "game_id", "is_upcoming",
        r6("community_sentiment_score").alias("community_sentiment_score"),
        r6("prediction_confidence").alias("prediction_confidence"))


# ---------------------------------------------------------------- more sinks / SQL



@register
def decode_quarantine(spark, sf):
    """Messages that do not decode, with the reason (null / empty / malformed)."""
    return st.quarantine(envelope_of(spark, sf)).select("timestamp", "reason")


@register
def sql_list_scores(spark, sf):
    """Genre and platform scores through the SQL functions, from SQL text."""
    register_sql_functions(spark)
    view = f"playlens_games_{zlib.crc32(sf.encode())}"
    stream_games(spark, sf).select("id", "genres", "platforms").createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT id, round(genre_popularity_score(genres), 6) AS genre_popularity_score,
               round(platform_reach_score(platforms), 6) AS platform_reach_score
        FROM {view}""")


@register
def bulk_import(spark, sf):
    """Bulk back-fill since the page bound, appended to a fresh folder under
    the shared checkpoint directory, read back."""
    out = shared_dir(spark, f"bulk_import/{uuid.uuid4().hex}")
    jobs.bulk_import(raw_games(spark, sf), fx.dimension_maps(), out, AS_OF,
                     bound_epoch=PAGE_BOUND)
    d = spark.read.parquet(out)
    return d.select("game_id", "release_date", "days_since_release", "is_released",
                    "is_upcoming", "success_level", r6("hype_score").alias("hype_score"),
                    r6("longevity_score").alias("longevity_score"),
                    joined("genres").alias("genres"))


@register
def crawl_messages(spark, sf):
    """Crawl batch as topic messages (key, JSON value), fields read back."""
    m = jobs.crawl(raw_games(spark, sf), fx.dimension_maps(), AS_OF)
    v = F.col("value")
    return m.select(F.col("key").cast("int").alias("id"),
                    F.get_json_object(v, "$.hypes").alias("j_hypes"),
                    F.get_json_object(v, "$.is_upcoming").alias("j_is_upcoming"),
                    F.get_json_object(v, "$.genres").alias("j_genres"))
