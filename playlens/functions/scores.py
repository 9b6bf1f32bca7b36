"""Popularity, reach, engagement, success and confidence scores.

The two list scores are higher-order functions over a literal weight map, so
they stay inside whole-stage codegen instead of a per-row Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(v: float) -> Column:
    return F.lit(float(v))


def sql_literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(int(v))


def literal_map(d: dict) -> Column:
    """A constant MAP column (folded into the plan), built as one SQL
    expression rather than one call per entry."""
    if not d:
        return F.create_map()
    return F.expr("map(" + ", ".join(f"{sql_literal(k)}, {sql_literal(v)}"
                                     for k, v in d.items()) + ")")


def weight_sum(arr, weights: dict, default: float) -> Column:
    """Left-to-right sum of per-element weights (missing -> default)."""
    m = literal_map({k: float(v) for k, v in weights.items()})
    return F.aggregate(_c(arr), _d(0.0),
                       lambda acc, x: acc + F.coalesce(F.try_element_at(m, x), _d(default)))


def _empty(arr) -> Column:
    a = _c(arr)
    return a.isNull() | (F.size(a) == 0)


def genre_popularity_score(genres="genres") -> Column:
    """min(100, mean genre weight x 50); 0.0 for null or empty lists."""
    g = _c(genres)
    mean = weight_sum(g, C.GENRE_WEIGHTS, C.GENRE_DEFAULT_WEIGHT) / F.size(g)
    return F.when(_empty(g), _d(0.0)).otherwise(
        F.least(_d(C.SCORE_CAP), mean * C.GENRE_SCALE))


def platform_reach_score(platforms="platforms") -> Column:
    """min(100, summed platform weight x 25); 0.0 for null or empty lists."""
    p = _c(platforms)
    total = weight_sum(p, C.PLATFORM_WEIGHTS, C.PLATFORM_DEFAULT_WEIGHT)
    return F.when(_empty(p), _d(0.0)).otherwise(
        F.least(_d(C.SCORE_CAP), total * C.PLATFORM_SCALE))


def native_score(hypes="hypes", follows="follows") -> Column:
    """Engagement score from hypes and follows; null if either is null."""
    h, f = _c(hypes), _c(follows)
    hf = F.least(_d(C.SCORE_CAP), h / C.NATIVE_HYPES_FULL * C.NATIVE_SCALE)
    ff = F.least(_d(C.SCORE_CAP), f / C.NATIVE_FOLLOWS_FULL * C.NATIVE_SCALE)
    return F.when(h.isNotNull() & f.isNotNull(), (hf + ff) / 2.0)


def success_score(success_class="predicted_success_class") -> Column:
    s = _c(success_class)
    return F.when(s.isNotNull(), s * C.SUCCESS_SCORE_PER_CLASS).cast("double")


CONFIDENCE_INPUTS = ["hypes", "follows", "rating_count", "franchise_count",
                     "platform_count", "genre_count"]


def base_confidence(cols=None) -> Column:
    """Share of positive engagement/coverage inputs (boolean -> int sum)."""
    cols = cols or CONFIDENCE_INPUTS
    total = None
    for c in cols:
        term = (_c(c) > 0).cast("int")
        total = term if total is None else total + term
    return total / float(len(cols))


def sentiment_boost(volume="community_data_volume") -> Column:
    v = _c(volume)
    out = _d(0.0)
    for at_least, boost in reversed(C.CONFIDENCE_BOOSTS):
        out = F.when(v >= at_least, _d(boost)).otherwise(out)
    return out


def prediction_confidence(volume="community_data_volume", cols=None) -> Column:
    """(base confidence + volume boost) x 100; uncapped (max 115)."""
    return (base_confidence(cols) + sentiment_boost(volume)) * 100
