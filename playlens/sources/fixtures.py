"""Game-domain inputs derived from the driver tables (see FIXTURES.md).

* ``games``   : one raw game per order, id arrays aggregated from its lines
* ``posts``   : community posts, one per event
* ``reviews`` : review pages, one per web page
* ``dimension``: id -> name tables

Every derivation is a plain projection or a bounded aggregation (an order
has a handful of lines), so the work grows linearly with the tables and
partitions on the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .tables import read_table


def _mask(expr: str) -> Column:
    """Bit set of a small non-negative per-line value (< 63)."""
    return F.expr(f"bit_or(shiftleft(1L, {expr}))")


def _from_mask(mask: str, size: int) -> Column:
    """Sorted ids present in a bit set of ``size`` bits."""
    return F.expr(f"filter(sequence(0, {size - 1}), i -> (shiftright({mask}, i) & 1L) = 1L)")


def _set(expr: str) -> Column:
    """Sorted distinct ids of a per-line value (nulls dropped).  The set is
    deduplicated inside the partial aggregation, so a group's buffer is
    bounded by its distinct values (the output), not by its rows."""
    return F.sort_array(F.collect_set(F.expr(f"CAST({expr} AS INT)")))


# small-domain arrays: (name, per-line value, domain size)
_MASKED = [
    ("franchises", f"l_partkey % {C.FRANCHISE_MOD}", C.FRANCHISE_MOD),
    ("genres", f"l_partkey % {C.GENRE_MOD}", C.GENRE_MOD),
    ("platforms", f"l_suppkey % {C.PLATFORM_MOD}", C.PLATFORM_MOD),
    ("themes", f"l_partkey % {C.THEME_MOD}", C.THEME_MOD),
    ("game_modes", f"l_linenumber % {C.GAME_MODE_MOD}", C.GAME_MODE_MOD),
    ("player_perspectives", f"l_suppkey % {C.PERSPECTIVE_MOD}", C.PERSPECTIVE_MOD),
    ("websites", "l_suppkey % 2", 2),
]
# open-domain arrays: (name, per-line value)
_SETS = [
    ("involved_companies", "l_suppkey"),
    ("screenshots", "l_linenumber"),
    ("videos", "CASE WHEN l_returnflag = 'R' THEN l_linenumber END"),
    ("artworks", "CASE WHEN l_linestatus = 'F' THEN l_linenumber END"),
    ("similar_games", "l_partkey"),
    ("expansions", "CASE WHEN l_discount >= 0.05D THEN l_linenumber END"),
    ("bundles", "CASE WHEN l_tax >= 0.07D THEN l_linenumber END"),
]
ARRAY_ORDER = ["franchises", "genres", "platforms", "themes", "game_modes",
               "player_perspectives", "involved_companies", "screenshots", "videos",
               "artworks", "websites", "similar_games", "expansions", "bundles"]


def line_arrays(lineitem: DataFrame) -> DataFrame:
    """Per order: quantity and every id array of the raw game.

    Every aggregate is skew-safe: small-domain arrays are bit sets combined
    with ``bit_or`` (algebraic, map-side partial aggregation), the others are
    ``collect_set`` whose buffers hold distinct values only.  A hot order
    therefore never holds its rows in one buffer."""
    aggs = [F.sum(F.col("l_quantity").cast("int")).cast("int").alias("q")]
    aggs += [_mask(e).alias(f"_m_{n}") for n, e, _ in _MASKED]
    aggs += [_set(e).alias(n) for n, e in _SETS]
    per_order = lineitem.groupBy("l_orderkey").agg(*aggs)
    decoded = {n: _from_mask(f"_m_{n}", size).alias(n) for n, _, size in _MASKED}
    return per_order.select("l_orderkey", "q",
                            *[decoded.get(n, F.col(n)) for n in ARRAY_ORDER])


def games(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """Raw games (RAW_GAME shape): orders left-joined to their line arrays.

    Both sides grow with the data (one row per order), so neither is
    broadcast: the aggregate is hash-partitioned on ``l_orderkey`` already and
    the sort-merge join, which spills where a hash join would not, re-partitions
    only ``orders`` on the same key; projections downstream run in parallel.
    ``ids`` (a bounded frame with a column ``id``) restricts orders and lines
    before the lines are aggregated.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        "o_orderdate", "o_orderpriority")
    lines = read_table(spark, sf_dir, "lineitem")
    if ids is not None:
        few = F.broadcast(ids.select(F.col("id").cast("long").alias("_id")))
        o = o.join(few, F.col("o_orderkey") == F.col("_id"), "left_semi")
        lines = lines.join(few, F.col("l_orderkey") == F.col("_id"), "left_semi")
    li = line_arrays(lines)
    j = o.join(li.hint("merge"), o.o_orderkey == li.l_orderkey, "left")
    q = F.col("q")
    price = F.col("o_totalprice")
    epoch = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    return j.select(
        F.col("o_orderkey").cast("int").alias("id"),
        F.concat(F.lit("Game "), F.col("o_orderkey").cast("string")).alias("name"),
        (F.col("o_custkey") % 5).cast("int").alias("category"),
        (F.col("o_custkey") % 8).cast("int").alias("status"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(price / 5000)
        .cast("double").alias("rating"),
        (q * 4).alias("rating_count"),
        (price / 6000).alias("aggregated_rating"),
        q.alias("aggregated_rating_count"),
        (price / 5500).alias("total_rating"),
        (q * 5).alias("total_rating_count"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise((F.col("o_custkey") % 120).cast("int")).cast("int").alias("hypes"),
        F.col("o_custkey").cast("int").alias("follows"),
        F.when(F.col("o_orderkey") % 50 == 0, F.lit(None)).otherwise(epoch)
        .cast("long").alias("first_release_date"),
        "franchises", "genres", "platforms", "themes", "game_modes",
        "player_perspectives", "involved_companies", "screenshots", "videos",
        "artworks", "websites", "similar_games", "expansions", "bundles",
    )


# title per event type; 'badge collectors' hits the keyword 'bad'
POST_TITLES = {
    "purchase": "Amazing and epic launch",
    "view": "Just a look",
    "signup": "BEST game ever",
    "error": "buggy mess, terrible port",
}
POST_TITLE_OTHER = "badge collectors"


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community posts ``(game_id, title, score, posted_at, event_id)``; their
    relevance order within a game is time, then event id."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value")
    title = F.lit(POST_TITLE_OTHER)
    for k, v in reversed(list(POST_TITLES.items())):
        title = F.when(F.col("event_type") == k, F.lit(v)).otherwise(title)
    return ev.select(
        F.col("user_id").cast("int").alias("game_id"),
        title.alias("title"),
        (F.floor("value").cast("int") - 20).alias("score"),
        F.col("ts").cast("timestamp").alias("posted_at"),
        "event_id",
    )


REVIEW_BLOCK_NO_SPAN = ('<div class="c-siteReviewScore_user"><p>tbd</p></div>'
                        '<div class="x"><span>1.0</span></div>')
REVIEW_BLOCK_TEXT = '<div class="c-siteReviewScore_user"><span>tbd</span></div>'


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review pages ``(game_id, slug, html)``; the user-score block is appended
    by a rule on ``page_id`` (none / no span / text / a numeric score)."""
    pg = read_table(spark, sf_dir, "pages").select("page_id", "html")
    pid, html = F.col("page_id"), F.col("html")
    score_txt = ((pid % 100).cast("double") / 10).cast("string")
    block = F.concat(F.lit('<div class="big c-siteReviewScore_user g-text"><span> '),
                     score_txt, F.lit(" </span></div>"))
    out = (F.when(pid % 10 == 9, html)
           .when(pid % 10 == 8, F.concat(html, F.lit(REVIEW_BLOCK_NO_SPAN)))
           .when(pid % 10 == 7, F.concat(html, F.lit(REVIEW_BLOCK_TEXT)))
           .otherwise(F.concat(html, block)))
    slug = F.translate(F.lower(F.concat(F.lit("Game: "), pid.cast("string"))), " :", "-")
    return pg.select(pid.cast("int").alias("game_id"), slug.alias("slug"),
                     out.alias("html"))


_USER = '<div class="big c-siteReviewScore_user g-text">'
#: Score blocks by ``page_id % 8`` (text before and after the score); the last is padded by inner divs.
NESTED_BLOCKS = [
    (_USER + '<div class="a"><div>n</div></div><span> ', ' </span></div>'),
    (_USER + '<div><p>tbd</p></div></div><span>', '</span>'),
    (_USER + '<div>a</div><div><span><b>', '</b></span></div></div><span>1</span>'),
    (_USER + '<!-- <span>9</span> --><script>var a="</div><span>8</span>";</script><span>', '</span></div>'),
    (_USER + '<span>', '<span>5</span></span></div>'),
    ('<div class="c-siteReviewScore_user-old"><span>', '</span></div>'),
    (_USER + '<div><SPAN class="s">', '</div><p>9</p></div>'),
    (_USER + '<br/>', '<span/></div>'),
]
NESTED_FILLER = "<div>" + "a < b, " * 30 + "</div>"
NESTED_LONG_PAGE = 15          # its block is over 10 MB; the others of the last kind have 50 inner divs


def nested_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review pages ``(page_id, html)`` whose score block holds nested tags, by
    a rule on ``page_id`` (see ``NESTED_BLOCKS``)."""
    pg = read_table(spark, sf_dir, "pages").select("page_id", "html")
    pid, html = F.col("page_id"), F.col("html")
    score_txt = ((pid % 100).cast("double") / 10).cast("string")
    out = None
    for k, (before, after) in enumerate(NESTED_BLOCKS[:-1]):
        block = F.concat(html, F.lit(before), score_txt, F.lit(after))
        out = F.when(pid % 8 == k, block) if out is None else out.when(pid % 8 == k, block)
    before, after = NESTED_BLOCKS[-1]
    n = F.when(pid == NESTED_LONG_PAGE, 50_000).otherwise(50)
    padded = F.concat(html, F.lit(before), F.repeat(F.lit(NESTED_FILLER), n), F.lit("<span>"),
                      score_txt, F.lit("</span>" + after))
    return pg.select("page_id", out.otherwise(padded).alias("html"))


DIMENSIONS = {
    "genres": C.DIM_GENRES,
    "platforms": C.DIM_PLATFORMS,
    "game_modes": C.DIM_GAME_MODES,
    "themes": C.DIM_THEMES,
    "player_perspectives": C.DIM_PERSPECTIVES,
}


def dimension(spark: SparkSession, kind: str) -> DataFrame:
    """Dimension ``(id int, name string)``; ids are list positions."""
    names = DIMENSIONS[kind]
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)],
                                 "id int, name string")


def dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    """The five dimensions as tables (the general, any-size form)."""
    return {k: dimension(spark, k) for k in DIMENSIONS}


def dimension_maps() -> dict[str, dict[int, str]]:
    """The five fixture dimensions as bounded ``{id: name}`` maps (fixed
    values: folded into the plan without a job)."""
    return {k: dict(enumerate(v)) for k, v in DIMENSIONS.items()}


#: In mixed arrays every so many elements are names; a name that no dimension has is written for some.
MIXED_EVERY, MIXED_STRANGE_EVERY, MIXED_STRANGE = 2, 11, "Homebrew"


def mixed_games(games: DataFrame) -> DataFrame:
    """Games whose five dimension arrays mix ids and names (VARIANT): the element at place p of game i is the
    name of its id if (i + p) % 2 = 0, or a name of no dimension if (i + p) % 11 = 0, and else the id."""
    def text(kind, names):
        table = F.array(*[F.lit(n) for n in names])

        def one(x, p):
            n = F.col("id") + p
            name = F.when(n % MIXED_STRANGE_EVERY == 0, F.lit(MIXED_STRANGE)).when(n % MIXED_EVERY == 0, F.get(table, x))
            return F.coalesce(F.concat(F.lit('"'), name, F.lit('"')), x.cast("string"))

        return F.concat(F.lit("["), F.array_join(F.transform(F.col(kind), one), ","), F.lit("]"))

    return games.withColumns({k: F.parse_json(text(k, v)).cast("array<variant>") for k, v in DIMENSIONS.items()})


# envelope rule: a few ids carry undecodable messages (decode tests)
ENVELOPE_BAD = {999: "not json", 998: ""}
ENVELOPE_NULL_ID = 997


def envelope(records: DataFrame, as_of: int, key: str = "id") -> DataFrame:
    """Topic envelope ``(timestamp, value)`` of game records: the record as
    JSON, except ids ending in 997/998/999 (per thousand) which carry a null,
    an empty and a malformed value."""
    k = F.col(key) % 1000
    value = F.to_json(F.struct(*[F.col(c) for c in records.columns]))
    for rem, bad in ENVELOPE_BAD.items():
        value = F.when(k == rem, F.lit(bad)).otherwise(value)
    value = F.when(k == ENVELOPE_NULL_ID, F.lit(None).cast("string")).otherwise(value)
    ts = F.date_format(F.timestamp_seconds(F.lit(as_of) + (F.col(key) % 600)),
                       "yyyy-MM-dd HH:mm:ss")
    return records.select(ts.alias("timestamp"), value.alias("value"))
