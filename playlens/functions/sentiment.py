"""Row-level sentiment expressions: post keyword/vote scoring, labels, review
slug and score extraction, source blend."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(v: float) -> Column:
    return F.lit(float(v))


def keyword_hits(title, keywords: list[str]) -> Column:
    """How many keywords occur as substrings of the lower-cased title; each
    keyword counts at most once ('bad' also hits 'badge')."""
    from .scores import sql_literal
    if isinstance(title, str):
        t = f"lower(coalesce(`{title}`, ''))"
        return F.expr(" + ".join(f"CAST(contains({t}, {sql_literal(k)}) AS INT)"
                                 for k in keywords))
    t = F.lower(F.coalesce(_c(title), F.lit("")))
    total = None
    for k in keywords:
        term = t.contains(k).cast("int")
        total = term if total is None else total + term
    return total


def vote_sentiment(score) -> Column:
    """Tier of the post's vote score (order of the checks matters)."""
    s = F.coalesce(_c(score), F.lit(0))
    low_at, low_val = C.POST_SCORE_LOW
    out = F.when(s < low_at, _d(low_val)).otherwise(_d(0.0))
    for above, val in reversed(C.POST_SCORE_TIERS):
        out = F.when(s > above, _d(val)).otherwise(out)
    return out


def keyword_sentiment(pos, neg) -> Column:
    """+-(difference / 2) clamped to [-1, 1]; 0 on a tie."""
    p, n = _c(pos), _c(neg)
    diff = (p - n) / 2.0
    return (F.when(p > n, F.least(_d(1.0), diff))
            .when(n > p, F.greatest(_d(-1.0), diff))
            .otherwise(_d(0.0)))


def post_sentiment(title="title", score="score") -> Column:
    """0.6 x keyword sentiment + 0.4 x vote tier, for one post."""
    kw = keyword_sentiment(keyword_hits(title, C.POSITIVE_KEYWORDS),
                           keyword_hits(title, C.NEGATIVE_KEYWORDS))
    return kw * C.KEYWORD_WEIGHT + vote_sentiment(score) * C.VOTE_WEIGHT


def rescale(avg) -> Column:
    """Mean post sentiment in [-1, 1] -> [0, 100]."""
    return (_c(avg) + 1.0) * 50.0


def label(score, positive_at=C.LABEL_POSITIVE_AT,
          neutral_at=C.LABEL_NEUTRAL_AT) -> Column:
    s = _c(score)
    return F.when(s.isNull(), F.lit(None).cast("string")) \
        .when(s >= positive_at, F.lit("positive")) \
        .when(s >= neutral_at, F.lit("neutral")) \
        .otherwise(F.lit("negative"))


def review_label(score) -> Column:
    return label(score, C.REVIEW_POSITIVE_AT, C.REVIEW_NEUTRAL_AT)


def name_slug(name="name") -> Column:
    """lower-case, spaces to '-', ':' removed."""
    return F.translate(F.lower(_c(name)), " :", "-")


# Comments, scripts and styles hold no tags; one left open reaches to the end of the page.
REVIEW_OPAQUE = (r'(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)'
                 r'|<style\b.*?(?:</style\s*>|\z)')
# First <div> whose class list holds the user-score token.
REVIEW_DIV = (r'(?i)<div(?:\s[^>]*)?\sclass="(?:[^"]*\s)?' + C.REVIEW_SCORE_CLASS
              + r'(?:\s[^"]*)?"[^>]*>')


def _first_span(tags: Column) -> Column:
    """Text of the first ``<span>`` inside the element whose content starts at
    ``tags`` (each a tag without its ``<``, and the text behind it).

    One fold over the tags carries the depth of divs (0: the element is closed)
    and, from the first span on, that of spans. A span also ends with the div
    around it. It finds the span's ends only; its text is put together once."""
    def step(s, tag):
        name = F.lower(F.regexp_extract(tag, r'^/?[^\s/>]*', 0))
        alone = tag.rlike(r'^[^>]*/>')
        div = F.when(name == "/div", -1).when((name == "div") & ~alone, 1).otherwise(0)
        span = F.when(name == "/span", -1).when((name == "span") & ~alone, 1).otherwise(0)
        found = s["first"].isNotNull()
        begins = ~found & (name == "span")
        depth, spans = s["depth"] + div, F.when(found, s["spans"]).otherwise(0) + span
        ends = (found & ((spans <= 0) | (depth < s["around"]))) | (begins & alone)
        after = F.struct(
            (s["at"] + 1).alias("at"), depth.alias("depth"), spans.alias("spans"),
            F.when(begins, s["at"]).otherwise(s["first"]).alias("first"),
            F.when(begins, s["depth"]).otherwise(s["around"]).alias("around"),
            (ends | (~found & (depth <= 0))).alias("done"),
            F.when(ends, s["at"]).otherwise(s["last"]).alias("last"))
        return F.when(s["done"], s).otherwise(after)

    none = F.lit(None).cast("int")
    start = F.struct(F.lit(1).alias("at"), F.lit(1).alias("depth"), F.lit(0).alias("spans"),
                     none.alias("first"), none.alias("around"), F.lit(False).alias("done"),
                     none.alias("last"))

    def text(s):
        inside = F.slice(tags, s["first"], F.coalesce(s["last"], F.size(tags) + 1) - s["first"])
        return F.array_join(F.transform(inside, lambda t: F.regexp_replace(t, r'^[^>]*>?', "")), "")

    return F.aggregate(tags, start, step, lambda s: F.when(s["first"].isNotNull(), text(s)))


def review_user_score(html="html") -> Column:
    """User score on the page x 10, null when absent or not a number.

    Tags are balanced: the span may lie in an inner div, after closed inner
    divs, and may hold tags itself; a span behind the closed element is not its own."""
    page = F.regexp_replace(_c(html), REVIEW_OPAQUE, "")
    inside = F.get(F.split(page, REVIEW_DIV, 2), F.lit(1))
    # bound to a lambda variable, so that the page is cut once
    text = F.transform(F.array(F.split(inside, r'<(?=[a-zA-Z/])')),
                       lambda parts: _first_span(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))))
    txt = F.regexp_replace(F.get(text, F.lit(0)), r"^\s+|\s+$", "")
    return txt.try_cast("double") * C.REVIEW_SCALE


def blend(scores: list[Column], weights: list[float]) -> Column:
    """Weighted mean over the sources that are present (non-null)."""
    num, den = _d(0.0), _d(0.0)
    for s, w in zip(scores, weights):
        num = num + F.coalesce(s * w, _d(0.0))
        den = den + F.when(s.isNotNull(), _d(w)).otherwise(_d(0.0))
    return F.when(den > 0, num / den)


def source_list(scores: list[Column], names: list[str]) -> Column:
    """Names of present sources joined by '+', null when none."""
    parts = [F.when(s.isNotNull(), F.lit(n)) for s, n in zip(scores, names)]
    out = F.concat_ws("+", *parts)
    return F.when(out == "", F.lit(None).cast("string")).otherwise(out)


def memo_key(name="name", days_to="days_to_release") -> Column:
    """Memo key: name + '_' + week bucket of the days to release."""
    return F.concat_ws("_", _c(name),
                       F.floor(_c(days_to) / C.MEMO_WEEK_DAYS).cast("string"))
