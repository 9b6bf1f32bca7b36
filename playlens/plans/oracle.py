"""DuckDB SQL oracles for the registered queries.

Each oracle is written independently of the Spark code, in plain SQL over
the driver tables (pre-registered views).  Shared fixture derivations are
CTEs; ``sql(select, *ctes)`` pulls in the CTEs a query needs, with their
dependencies, in order.
"""

from __future__ import annotations

from .. import constants as C
from ..sources.fixtures import (POST_TITLE_OTHER, POST_TITLES,
                                REVIEW_BLOCK_NO_SPAN, REVIEW_BLOCK_TEXT)

# RE2 has no look-ahead: the oracle skips text and opening tags other than
# <s...> and stops at any closing tag (equal on the fixture pages).
REVIEW_DIV = r'<div[^>]*class="[^"]*\bc-siteReviewScore_user\b[^"]*"[^>]*>'
REVIEW_SCORE_PATTERN_RE2 = REVIEW_DIV + r'[^<]*(?:<[^/s][^<]*)*<span[^>]*>([^<]*)</span>'

AS_OF = C.AS_OF_EPOCH


def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _ids(expr: str, cond: str | None = None) -> str:
    if cond is None:
        return f"list_sort(list(DISTINCT CAST({expr} AS INTEGER)))"
    return (f"coalesce(list_sort(list(DISTINCT CAST({expr} AS INTEGER)) "
            f"FILTER (WHERE {cond})), []::INTEGER[])")


def _case_map(x: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {q(k) if isinstance(k, str) else k} THEN {v}"
                     for k, v in mapping.items())
    return f"CASE {x} {whens} ELSE {default} END"


def _names(col: str, names: list[str]) -> str:
    m = {i: q(n) for i, n in enumerate(names)}
    body = _case_map("x", m, "'Unknown_' || CAST(x AS VARCHAR)")
    return f"coalesce(list_transform({col}, lambda x: {body}), []::VARCHAR[])"


def _ids_back(col: str, names: list[str]) -> str:
    inv: dict[str, int] = {}
    for i, n in enumerate(names):
        inv.setdefault(n, i)
    body = _case_map("x", {k: v for k, v in inv.items()}, "NULL")
    return (f"coalesce(list_filter(list_transform({col}, lambda x: {body}), "
            f"lambda y: y IS NOT NULL), []::INTEGER[])")


def _mixed(col: str, names: list[str]) -> tuple[str, str]:
    """(ids, names) of a fixture array that mixes both: strange names have no id, names the lowest one."""
    first = {i: names.index(n) for i, n in enumerate(names)}
    place = "(id + i - 1)"
    ids = (f"CASE WHEN {place} % 11 = 0 THEN NULL WHEN {place} % 2 = 0 THEN {_case_map('x', first, 'x')} ELSE x END")
    name = _case_map("x", {i: q(n) for i, n in enumerate(names)}, "'Unknown_' || CAST(x AS VARCHAR)")
    return (f"coalesce(list_filter(list_transform({col}, lambda x, i: {ids}), lambda y: y IS NOT NULL), []::INTEGER[])",
            f"coalesce(list_transform({col}, lambda x, i: CASE WHEN {place} % 11 = 0 THEN 'Homebrew' ELSE {name} END), []::VARCHAR[])")


def _weights(col: str, weights: dict, default: float) -> str:
    m = {k: D(v) for k, v in weights.items()}
    body = _case_map("g", m, D(default))
    return (f"list_reduce(list_prepend({D(0.0)}, list_transform({col}, lambda g: {body})), "
            f"lambda a, b: a + b)")


def _size(col: str) -> str:
    return f"CAST(coalesce(len({col}), 0) AS INTEGER)"


def _label(x: str, pos, neu) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} >= {pos} THEN 'positive' "
            f"WHEN {x} >= {neu} THEN 'neutral' ELSE 'negative' END")


def joined(col: str) -> str:
    return f"array_to_string({col}, '|')"


def iso(epoch: str) -> str:
    return f"strftime(to_timestamp({epoch}), '%Y-%m-%dT%H:%M:%S')"


_KW_POS = " + ".join(f"CAST(contains(lower(title), {q(k)}) AS INTEGER)"
                     for k in C.POSITIVE_KEYWORDS)
_KW_NEG = " + ".join(f"CAST(contains(lower(title), {q(k)}) AS INTEGER)"
                     for k in C.NEGATIVE_KEYWORDS)
_TITLE = _case_map("event_type", {k: q(v) for k, v in POST_TITLES.items()},
                   q(POST_TITLE_OTHER))

POSTS_HI = f"TIMESTAMP {q(C.POSTS_AS_OF)}"


def _post_agg(rows: str) -> str:
    return f"""
SELECT game_id, post_volume, scored_posts, total_post_score,
  CASE WHEN scored_posts > 0 THEN (a + {D(1.0)}) * {D(50.0)} ELSE {D(0.0)} END AS reddit_score,
  CASE WHEN scored_posts > 0 THEN
    {_label(f'(a + {D(1.0)}) * {D(50.0)}', 60, 40)} ELSE 'neutral' END AS reddit_label
FROM (SELECT game_id, avg(CASE WHEN rank <= 50 THEN s END) AS a,
        CAST(count(*) AS INTEGER) AS post_volume,
        CAST(count(CASE WHEN rank <= 50 THEN 1 END) AS INTEGER) AS scored_posts,
        CAST(sum(CASE WHEN rank <= 50 THEN score END) AS BIGINT) AS total_post_score
      FROM {rows} GROUP BY game_id)"""


CTES: dict[str, tuple[str, list[str]]] = {
    "li": (f"""
SELECT l_orderkey,
  CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) AS q,
  {_ids(f'l_partkey % {C.FRANCHISE_MOD}')} AS franchises,
  {_ids(f'l_partkey % {C.GENRE_MOD}')} AS genres,
  {_ids(f'l_suppkey % {C.PLATFORM_MOD}')} AS platforms,
  {_ids(f'l_partkey % {C.THEME_MOD}')} AS themes,
  {_ids(f'l_linenumber % {C.GAME_MODE_MOD}')} AS game_modes,
  {_ids(f'l_suppkey % {C.PERSPECTIVE_MOD}')} AS player_perspectives,
  {_ids('l_suppkey')} AS involved_companies,
  {_ids('l_linenumber')} AS screenshots,
  {_ids('l_linenumber', "l_returnflag = 'R'")} AS videos,
  {_ids('l_linenumber', "l_linestatus = 'F'")} AS artworks,
  {_ids('l_suppkey % 2')} AS websites,
  {_ids('l_partkey')} AS similar_games,
  {_ids('l_linenumber', 'l_discount >= 0.05')} AS expansions,
  {_ids('l_linenumber', 'l_tax >= 0.07')} AS bundles
FROM lineitem GROUP BY l_orderkey""", []),
    "games": (f"""
SELECT CAST(o_orderkey AS INTEGER) AS id,
  'Game ' || CAST(o_orderkey AS VARCHAR) AS name,
  CAST(o_custkey % 5 AS INTEGER) AS category,
  CAST(o_custkey % 8 AS INTEGER) AS status,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 5000 END AS rating,
  q * 4 AS rating_count,
  o_totalprice / 6000 AS aggregated_rating,
  q AS aggregated_rating_count,
  o_totalprice / 5500 AS total_rating,
  q * 5 AS total_rating_count,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL
       ELSE CAST(o_custkey % 120 AS INTEGER) END AS hypes,
  CAST(o_custkey AS INTEGER) AS follows,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL
       ELSE CAST(epoch(o_orderdate) AS BIGINT) END AS first_release_date,
  franchises, genres, platforms, themes, game_modes, player_perspectives,
  involved_companies, screenshots, videos, artworks, websites, similar_games,
  expansions, bundles
FROM orders LEFT JOIN li ON o_orderkey = l_orderkey""", ["li"]),
    # translated: ids kept, names resolved
    "gtr": (f"""
SELECT * REPLACE (
    {_names('genres', C.DIM_GENRES)} AS genres,
    {_names('platforms', C.DIM_PLATFORMS)} AS platforms,
    {_names('game_modes', C.DIM_GAME_MODES)} AS game_modes,
    {_names('themes', C.DIM_THEMES)} AS themes,
    {_names('player_perspectives', C.DIM_PERSPECTIVES)} AS player_perspectives),
  genres AS genre_ids, platforms AS platform_ids, game_modes AS game_mode_ids,
  themes AS theme_ids, player_perspectives AS player_perspective_ids
FROM games""", ["games"]),
    "gt0": (f"""
SELECT *,
  CAST(floor(({AS_OF} - rel) / 86400) AS INTEGER) AS days_since_release,
  CAST(floor((rel - {AS_OF}) / 86400) AS INTEGER) AS days_to_release,
  {iso('rel')} AS release_date_formatted
FROM (SELECT *, CASE WHEN first_release_date = 0 THEN NULL
                     ELSE first_release_date END AS rel FROM gtr)""", ["gtr"]),
    "gt1": (f"""
SELECT *,
  coalesce(days_since_release >= 0, false) AS is_released,
  coalesce(days_to_release >= 0, false) AS is_upcoming,
  {_size('franchises')} AS franchise_count,
  {_size('platforms')} AS platform_count,
  {_size('genres')} AS genre_count,
  {_size('involved_companies')} AS company_count,
  {_size('videos')} AS video_count,
  {_size('screenshots')} AS screenshot_count,
  {_size('websites')} AS website_count,
  CAST({_size('videos')} + {_size('screenshots')} + {_size('artworks')} AS INTEGER)
    AS marketing_intensity,
  {_size('game_modes')} > 1 AS has_multiplayer,
  {_size('expansions')} > 0 AS has_expansions
FROM gt0""", ["gt0"]),
    # metrics of the crawler
    "gm": (f"""
SELECT *,
  CASE WHEN is_upcoming AND days_to_release >= 0 THEN least({D(100.0)},
    ((coalesce(hypes, 0) * {D(2.0)} + coalesce(follows, 0) * {D(1.5)}
      + coalesce(rating_count, 0) * {D(0.5)})
     * CASE WHEN days_to_release <= 365
            THEN greatest({D(0.0)}, {D(1.0)} - days_to_release / {D(365.0)})
            ELSE {D(0.3)} END) / {D(10.0)}) END AS hype_score,
  CASE WHEN is_released AND days_since_release > 0 THEN
    coalesce(rating, {D(0.0)}) / {D(100.0)} * 40
    + least({D(1.0)}, coalesce(rating_count, 0) / {D(1000.0)}) * 30
    + least({D(1.0)}, franchise_count / {D(5.0)}) * 15
    + least({D(1.0)}, platform_count / {D(10.0)}) * 10
    + CASE WHEN days_since_release / {D(365.0)} > 1
           THEN least({D(1.0)}, days_since_release / {D(365.0)} / {D(10.0)})
           ELSE {D(0.5)} END * 5 END AS longevity_score,
  CASE WHEN rating IS NOT NULL AND rating <> 0 AND rating_count IS NOT NULL
            AND rating_count <> 0 THEN
    CASE WHEN rating >= 80 AND rating_count >= 500 THEN 2
         WHEN rating >= 60 AND rating_count >= 100 THEN 1 ELSE 0 END
  END AS success_level
FROM gt1""", ["gt1"]),
    # stream record after list scores and the null fill
    "gfill": (f"""
SELECT * REPLACE (
    coalesce(hypes, 0) AS hypes, coalesce(follows, 0) AS follows,
    coalesce(rating_count, 0) AS rating_count,
    coalesce(total_rating, 0) AS total_rating,
    coalesce(aggregated_rating, 0) AS aggregated_rating),
  CASE WHEN len(genres) = 0 THEN {D(0.0)} ELSE least({D(100.0)},
    {_weights('genres', C.GENRE_WEIGHTS, C.GENRE_DEFAULT_WEIGHT)} / len(genres) * {D(50.0)})
  END AS genre_popularity_score,
  CASE WHEN len(platforms) = 0 THEN {D(0.0)} ELSE least({D(100.0)},
    {_weights('platforms', C.PLATFORM_WEIGHTS, C.PLATFORM_DEFAULT_WEIGHT)} * {D(25.0)})
  END AS platform_reach_score
FROM gm""", ["gm"]),
    "posts": (f"""
SELECT CAST(user_id AS INTEGER) AS game_id, {_TITLE} AS title,
  CAST(floor(value) AS INTEGER) - 20 AS score, ts AS posted_at, event_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS rank
FROM events""", []),
    "post_rows": (f"""
SELECT game_id, rank, score, posted_at, event_id,
  CASE WHEN kp > kn THEN least({D(1.0)}, (kp - kn) / {D(2.0)})
       WHEN kn > kp THEN greatest({D(-1.0)}, (kp - kn) / {D(2.0)})
       ELSE {D(0.0)} END * {D(0.6)}
  + CASE WHEN score > 100 THEN {D(1.0)} WHEN score > 50 THEN {D(0.5)}
         WHEN score > 10 THEN {D(0.2)} WHEN score < -10 THEN {D(-0.5)}
         ELSE {D(0.0)} END * {D(0.4)} AS s
FROM (SELECT *, {_KW_POS} AS kp, {_KW_NEG} AS kn FROM posts)""", ["posts"]),
    # the last month's posts, ranked anew within the month
    "month_rows": (f"""
SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY game_id ORDER BY posted_at, event_id)
                       AS INTEGER) AS rank)
FROM post_rows
WHERE posted_at >= {POSTS_HI} - INTERVAL {C.POSTS_WINDOW_DAYS} DAY AND posted_at <= {POSTS_HI}""",
                   ["post_rows"]),
    "post_agg": (_post_agg("post_rows"), ["post_rows"]),
    "month_agg": (_post_agg("month_rows"), ["month_rows"]),
    "reviews": (f"""
SELECT CAST(page_id AS INTEGER) AS game_id,
  translate(lower('Game: ' || CAST(page_id AS VARCHAR)), ' :', '-') AS slug,
  CASE WHEN page_id % 10 = 9 THEN html
       WHEN page_id % 10 = 8 THEN html || {q(REVIEW_BLOCK_NO_SPAN)}
       WHEN page_id % 10 = 7 THEN html || {q(REVIEW_BLOCK_TEXT)}
       ELSE html || '<div class="big c-siteReviewScore_user g-text"><span> '
            || CAST(CAST(page_id % 100 AS DOUBLE) / 10 AS VARCHAR) || ' </span></div>'
  END AS html
FROM pages""", []),
    "review_agg": (f"""
SELECT slug, metacritic_score, {_label('metacritic_score', 75, 50)} AS metacritic_label
FROM (SELECT slug, arg_min(sc, game_id) AS metacritic_score
      FROM (SELECT slug, game_id,
              TRY_CAST(trim(regexp_extract(html, {q(REVIEW_SCORE_PATTERN_RE2)}, 1)) AS DOUBLE)
                * {D(10.0)} AS sc
            FROM reviews)
      GROUP BY slug)""", ["reviews"]),
    "community": (f"""
SELECT *,
  CASE WHEN gate THEN (CASE WHEN fin IS NULL OR fin = 0 THEN {D(50.0)} ELSE fin END)
       ELSE {D(50.0)} END AS community_sentiment_score,
  CASE WHEN gate THEN {_label('fin', 60, 40)} ELSE 'neutral' END AS community_sentiment_label,
  CASE WHEN gate AND fin IS NOT NULL THEN CAST(vol AS INTEGER) END AS community_data_volume,
  CASE WHEN gate THEN nullif(concat_ws('+',
      CASE WHEN r IS NOT NULL THEN 'reddit' END,
      CASE WHEN m IS NOT NULL THEN 'metacritic' END,
      CASE WHEN n IS NOT NULL THEN 'igdb' END), '') END AS sentiment_source
FROM (SELECT *,
  CASE WHEN den > 0 THEN num / den END AS fin
  FROM (SELECT *,
    {D(0.0)} + coalesce(r * {D(0.4)}, {D(0.0)}) + coalesce(m * {D(0.3)}, {D(0.0)})
      + coalesce(n * {D(0.3)}, {D(0.0)}) AS num,
    {D(0.0)} + CASE WHEN r IS NOT NULL THEN {D(0.4)} ELSE {D(0.0)} END
      + CASE WHEN m IS NOT NULL THEN {D(0.3)} ELSE {D(0.0)} END
      + CASE WHEN n IS NOT NULL THEN {D(0.3)} ELSE {D(0.0)} END AS den
    FROM (SELECT g.*,
        coalesce(pa.reddit_score, {D(0.0)}) AS r,
        coalesce(pa.post_volume, 0) AS vol,
        ra.metacritic_score AS m,
        CASE WHEN g.hypes IS NOT NULL AND g.follows IS NOT NULL THEN
          (least({D(100.0)}, g.hypes / {D(100.0)} * {D(50.0)})
           + least({D(100.0)}, g.follows / {D(1000.0)} * {D(50.0)})) / {D(2.0)} END AS n,
        coalesce(g.is_upcoming, false) AND g.days_to_release IS NOT NULL
          AND g.days_to_release >= 1 AND g.days_to_release <= 365 AS gate
      FROM gfill g
      LEFT JOIN month_agg pa ON g.id = pa.game_id
      LEFT JOIN review_agg ra ON translate(lower(g.name), ' :', '-') = ra.slug)))
""", ["gfill", "month_agg", "review_agg"]),
}


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][1]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def sql(select: str, *ctes: str) -> str:
    names = _order(ctes)
    if not names:
        return select
    body = ",\n".join(f"{n} AS ({CTES[n][0]}\n)" for n in names)
    return f"WITH {body}\n{select}"
