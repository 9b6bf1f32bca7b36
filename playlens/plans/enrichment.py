"""The enrichment plan: decoded game records -> output documents.

One lazy plan per batch: list scores -> null fill -> community sentiment
(pre-aggregated post and review sources, left-joined) -> model chain ->
success score and confidence -> document projection.  No collect, a single
action at the sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ..functions import scores as S
from ..operators import enrich
from ..operators.ml import predict_all
from ..operators.sentiment import with_community_sentiment
from ..sinks.documents import document


def score_records(games: DataFrame, posts: DataFrame, reviews: DataFrame,
                  models: dict | None = None, restrict_sources: bool = False,
                  posts_as_of: str | Column | None = None,
                  posts_until: str | None = None) -> DataFrame:
    g = enrich.with_list_scores(games)
    g = enrich.fill_defaults(g)
    g = with_community_sentiment(g, posts, reviews, restrict_sources=restrict_sources,
                                 posts_as_of=posts_as_of, posts_until=posts_until)
    g = predict_all(g, models or {})
    return g.withColumns({
        "predicted_success_score": S.success_score("predicted_success_class"),
        "prediction_confidence": S.prediction_confidence("community_data_volume"),
    })


def enrich_documents(games: DataFrame, posts: DataFrame, reviews: DataFrame,
                     batch_id: int, as_of: int, models: dict | None = None,
                     restrict_sources: bool = False,
                     posts_as_of: str | Column | None = None,
                     posts_until: str | None = None) -> DataFrame:
    return document(score_records(games, posts, reviews, models, restrict_sources, posts_as_of, posts_until),
                    batch_id, as_of)
