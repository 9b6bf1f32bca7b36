"""Oracle SQL per registered query (same keys and column names)."""

from __future__ import annotations

from .. import constants as C
from ..sources.fixtures import NESTED_BLOCKS, NESTED_FILLER, NESTED_LONG_PAGE
from .oracle import D, joined, q, sql

ORACLES: dict[str, str] = {}


def r6(x: str) -> str:
    return f"round({x}, 6)"


ORACLES["release_timing"] = sql("""
SELECT id, release_date_formatted, days_since_release, days_to_release,
  is_released, is_upcoming FROM gt1""", "gt1")

ORACLES["hype_score"] = sql(
    f"SELECT id, days_to_release, {r6('hype_score')} AS hype_score FROM gm", "gm")

ORACLES["longevity_score"] = sql(
    f"SELECT id, franchise_count, platform_count, {r6('longevity_score')} AS longevity_score "
    "FROM gm", "gm")

ORACLES["success_level"] = sql("SELECT id, success_level FROM gm", "gm")

ORACLES["array_counts"] = sql("""
SELECT id, franchise_count, platform_count, genre_count, company_count,
  video_count, screenshot_count, website_count, marketing_intensity,
  has_multiplayer, has_expansions FROM gm""", "gm")

_TR = f"""
SELECT id, {joined('genre_ids')} AS genre_ids, {joined('genres')} AS genres,
  {joined('platform_ids')} AS platform_ids, {joined('platforms')} AS platforms,
  {joined('game_modes')} AS game_modes, {joined('themes')} AS themes,
  {joined('player_perspectives')} AS player_perspectives FROM gtr"""
ORACLES["translate_ids"] = sql(_TR, "gtr")
ORACLES["translate_ids_join"] = sql(_TR, "gtr")


def _back(col: str, names: list[str]) -> str:
    from .oracle import _ids_back
    return _ids_back(col, names)


ORACLES["reverse_translate"] = sql(f"""
SELECT id, {joined(_back('genres', C.DIM_GENRES))} AS genre_ids_back,
  {joined(_back('platforms', C.DIM_PLATFORMS))} AS platform_ids_back FROM gtr""", "gtr")

_MIXED_DIMS = [("genres", "genre_ids", C.DIM_GENRES), ("platforms", "platform_ids", C.DIM_PLATFORMS),
               ("game_modes", "game_mode_ids", C.DIM_GAME_MODES), ("themes", "theme_ids", C.DIM_THEMES),
               ("player_perspectives", "player_perspective_ids", C.DIM_PERSPECTIVES)]


def _mixed_sql() -> str:
    from .oracle import _mixed
    cols = []
    for names_col, ids_col, names in _MIXED_DIMS:
        ids, found = _mixed(names_col, names)
        cols += [f"{joined(ids)} AS {ids_col}", f"{joined(found)} AS {names_col}"]
    return sql("SELECT id, " + ", ".join(cols) + " FROM games", "games")


ORACLES["translate_mixed_map"] = _mixed_sql()
ORACLES["translate_mixed_join"] = ORACLES["translate_mixed_map"]

_REPEATS = sql(f"""
SELECT id, CASE WHEN id % 7 <> 0 THEN id % 100 END AS key, {joined('genres')} AS names,
  {joined(_back('genres', C.DIM_GENRES))} AS back FROM gtr""", "gtr")
ORACLES["translate_repeats_map"] = _REPEATS
ORACLES["translate_repeats_join"] = _REPEATS

ORACLES["genre_popularity"] = sql(
    f"SELECT id, {r6('genre_popularity_score')} AS genre_popularity_score FROM gfill", "gfill")

ORACLES["platform_reach"] = sql(
    f"SELECT id, {r6('platform_reach_score')} AS platform_reach_score FROM gfill", "gfill")

ORACLES["native_score"] = sql(f"""
SELECT id, {r6(f'''CASE WHEN hypes IS NOT NULL AND follows IS NOT NULL THEN
  (least({D(100.0)}, hypes / {D(100.0)} * {D(50.0)})
   + least({D(100.0)}, follows / {D(1000.0)} * {D(50.0)})) / {D(2.0)} END''')} AS native_score
FROM games""", "games")

ORACLES["post_sentiment"] = sql(f"""
SELECT game_id, post_volume, scored_posts, total_post_score,
  {r6('reddit_score')} AS reddit_score, reddit_label FROM post_agg""", "post_agg")

ORACLES["review_score"] = sql(f"""
SELECT g.id, {r6('ra.metacritic_score')} AS metacritic_score, ra.metacritic_label
FROM games g LEFT JOIN review_agg ra ON translate(lower(g.name), ' :', '-') = ra.slug""",
                              "games", "review_agg")

_NESTED = " ".join(
    f"WHEN page_id % 8 = {k} THEN {q(before)} || CAST(CAST(page_id % 100 AS DOUBLE) / 10 AS VARCHAR) || {q(after)}"
    for k, (before, after) in enumerate(NESTED_BLOCKS[:-1]))

# Depths as running sums over the tags, the ends as least places, instead of a fold.
ORACLES["review_score_nested"] = f"""
WITH page AS (
  SELECT page_id, regexp_replace(html || CASE {_NESTED}
      ELSE {q(NESTED_BLOCKS[-1][0])}
        || repeat({q(NESTED_FILLER)}, CASE WHEN page_id = {NESTED_LONG_PAGE} THEN 50000 ELSE 50 END)
        || '<span>' || CAST(CAST(page_id % 100 AS DOUBLE) / 10 AS VARCHAR) || '</span>'
        || {q(NESTED_BLOCKS[-1][1])} END,
    '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g') AS html
  FROM pages),
cut AS (
  SELECT page_id, regexp_extract_all(regexp_extract(html,
      '(?s)<div [^>]*class="(?:[^"]* )?c-siteReviewScore_user(?: [^"]*)?"[^>]*>(.*)$', 1),
    '<[a-zA-Z/][^<]*(?:<[^a-zA-Z/][^<]*)*') AS tags
  FROM page),
tag AS (
  SELECT page_id, unnest(tags) AS t, generate_subscripts(tags, 1) AS i FROM cut),
named AS (
  SELECT page_id, i, regexp_replace(t, '^<[^>]*>', '') AS body,
    lower(regexp_extract(t, '^<(/?[a-zA-Z]+)', 1)) AS name,
    regexp_matches(t, '^<[^>]*/>') AS alone FROM tag),
depth AS (
  SELECT *,
    1 + sum(CASE WHEN name = '/div' THEN -1 WHEN name = 'div' AND NOT alone THEN 1 ELSE 0 END)
      OVER (PARTITION BY page_id ORDER BY i) AS divs,
    sum(CASE WHEN name = '/span' THEN -1 WHEN name = 'span' AND NOT alone THEN 1 ELSE 0 END)
      OVER (PARTITION BY page_id ORDER BY i) AS spans FROM named),
closed AS (SELECT page_id, min(CASE WHEN divs <= 0 THEN i END) AS e FROM depth GROUP BY 1),
span AS (
  SELECT page_id, min_by(divs, i) AS divs, min_by(spans, i) AS spans, min_by(alone, i) AS alone, min(i) AS b
  FROM depth JOIN closed USING (page_id) WHERE name = 'span' AND (e IS NULL OR i < e) GROUP BY 1),
ended AS (
  SELECT s.page_id, s.b, CASE WHEN any_value(s.alone) THEN s.b ELSE
    min(CASE WHEN d.i > s.b AND (d.spans < s.spans OR d.divs < s.divs) THEN d.i END) END AS e
  FROM span s JOIN depth d USING (page_id) GROUP BY s.page_id, s.b),
score AS (
  SELECT page_id, TRY_CAST(trim(string_agg(body, '' ORDER BY i)) AS DOUBLE) * 10 AS score
  FROM ended JOIN depth USING (page_id) WHERE i >= b AND (e IS NULL OR i < e) GROUP BY 1)
SELECT page_id, round(score, 6) AS user_score,
  CASE WHEN score >= 75 THEN 'positive' WHEN score >= 50 THEN 'neutral'
       WHEN score IS NOT NULL THEN 'negative' END AS user_label
FROM pages LEFT JOIN score USING (page_id)"""

ORACLES["community_sentiment"] = sql(f"""
SELECT id, {r6('community_sentiment_score')} AS community_sentiment_score,
  community_sentiment_label, community_data_volume, sentiment_source
FROM community""", "community")

ORACLES["posts_last_month"] = sql(f"""
SELECT g.id, coalesce(m.post_volume, 0) AS month_post_volume,
  {r6(f'coalesce(m.reddit_score, {D(0.0)})')} AS month_reddit_score
FROM games g LEFT JOIN month_agg m ON g.id = m.game_id""", "games", "month_agg")

ORACLES["posts_month_by_row"] = sql("""
SELECT r.event_id, r.game_id, coalesce(m.v, 0) AS month_post_volume,
  round(coalesce((m.a + 1.0::DOUBLE) * 50.0::DOUBLE, 0.0::DOUBLE), 6) AS month_reddit_score
FROM post_rows r LEFT JOIN (
  SELECT game_id, until, CAST(count(*) AS INTEGER) AS v, avg(CASE WHEN nth <= 50 THEN s END) AS a
  FROM (SELECT w.game_id, w.until, p.s,
          row_number() OVER (PARTITION BY w.game_id, w.until ORDER BY p.posted_at, p.event_id) AS nth
        FROM (SELECT DISTINCT game_id, posted_at AS until FROM post_rows) w
        JOIN post_rows p ON p.game_id = w.game_id
          AND p.posted_at >= w.until - INTERVAL 30 DAY AND p.posted_at <= w.until)
  GROUP BY game_id, until) m ON r.game_id = m.game_id AND r.posted_at = m.until""", "post_rows")


# ---------------------------------------------------------------- selections
RECENT_BOUND = C.AS_OF_EPOCH - C.RECENT_WINDOW_DAYS * C.SECONDS_PER_DAY
PAGE_BOUND = 883612800
_RECENT_IDS = f"""(SELECT id FROM games WHERE first_release_date >= {RECENT_BOUND}
   ORDER BY hypes DESC NULLS LAST, id LIMIT {C.RECENT_TOP_K})"""

ORACLES["upcoming_window"] = sql(f"""
SELECT id, days_to_release, {r6('hype_score')} AS hype_score FROM gm
WHERE is_upcoming AND days_to_release BETWEEN 1 AND 365""", "gm")

ORACLES["recent_top_hyped"] = sql(f"""
SELECT id, name, hypes, first_release_date, days_to_release, is_upcoming,
  {r6('hype_score')} AS hype_score
FROM gm WHERE id IN {_RECENT_IDS}""", "gm")

ORACLES["release_split"] = sql("""
SELECT CASE WHEN is_upcoming THEN 'upcoming' ELSE 'released' END AS split,
  CAST(count(*) AS INTEGER) AS n FROM gm GROUP BY 1""", "gm")

ORACLES["split_preview"] = sql(f"""
SELECT split, position, id, substr(name, 1, 40) AS name,
  CASE WHEN split = 'upcoming' THEN days_to_release ELSE days_since_release END AS days,
  {r6("CASE WHEN split = 'upcoming' THEN hype_score ELSE rating END")} AS metric,
  CASE WHEN len(genres) = 0 THEN 'N/A'
       ELSE array_to_string(genres[1:2], ', ') END AS genres_preview,
  CASE WHEN len(platforms) = 0 THEN 'N/A'
       ELSE array_to_string(platforms[1:2], ', ') END AS platforms_preview
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY split
                 ORDER BY hypes DESC NULLS LAST, id) AS INTEGER) AS position
      FROM (SELECT *, CASE WHEN is_upcoming THEN 'upcoming' ELSE 'released' END AS split
            FROM gm WHERE id IN {_RECENT_IDS}))
WHERE position <= {C.PREVIEW_ROWS}""", "gm")

ORACLES["release_page"] = sql(f"""
SELECT id, name, first_release_date FROM games
WHERE first_release_date >= {PAGE_BOUND}
ORDER BY first_release_date, id LIMIT {C.BULK_PAGE_SIZE} OFFSET {C.BULK_PAGE_SIZE}""", "games")

ORACLES["release_page_keyset"] = sql(f"""
SELECT id, name, first_release_date FROM games
WHERE first_release_date >= {PAGE_BOUND}
  AND (first_release_date > 915148800 OR (first_release_date = 915148800 AND id > 0))
ORDER BY first_release_date, id LIMIT {C.BULK_PAGE_SIZE}""", "games")

ORACLES["release_pages"] = sql(f"""
SELECT id, first_release_date, CAST((rn - 1) // {C.BULK_PAGE_SIZE} AS INTEGER) AS page,
  CAST((rn - 1) % {C.BULK_PAGE_SIZE} + 1 AS INTEGER) AS position
FROM (SELECT id, first_release_date,
        row_number() OVER (ORDER BY first_release_date, id) AS rn
      FROM games WHERE first_release_date >= {PAGE_BOUND})""", "games")

# ---------------------------------------------------------------- messages
_OK = "id % 1000 NOT IN (997, 998, 999)"
_TS = (f"strftime(to_timestamp({C.AS_OF_EPOCH} + id % 600), '%Y-%m-%d %H:%M:%S')")
_DEC_ROUNDED = {"rating", "total_rating", "aggregated_rating", "hype_score", "longevity_score"}
_DEC_COLS = ["id", "name", "rating", "rating_count", "hypes", "follows",
             "first_release_date", "total_rating", "aggregated_rating",
             "days_since_release", "days_to_release", "is_released", "is_upcoming",
             "franchise_count", "platform_count", "genre_count", "hype_score",
             "longevity_score", "success_level"]
_DEC_ARRAYS = ["franchises", "genres", "platforms", "genre_ids", "platform_ids",
               "game_modes", "themes"]
ORACLES["decode_games"] = sql(
    "SELECT " + _TS + " AS timestamp, "
    + ", ".join(f"{r6(c)} AS {c}" if c in _DEC_ROUNDED else c for c in _DEC_COLS) + ", "
    + ", ".join(f"{joined(a)} AS {a}" for a in _DEC_ARRAYS)
    + f" FROM gm WHERE {_OK}", "gm")


def _json_ints(c):
    return f"'[' || array_to_string({c}, ',') || ']'"


def _json_strs(c):
    return f"""'[' || array_to_string(list_transform({c}, lambda x: '"' || x || '"'), ',') || ']'"""


ORACLES["encode_games"] = sql(f"""
SELECT id, name AS j_name, CAST(hypes AS VARCHAR) AS j_hypes,
  {_json_ints('genre_ids')} AS j_genre_ids, {_json_strs('genres')} AS j_genres,
  CAST(is_upcoming AS VARCHAR) AS j_is_upcoming,
  CAST(days_to_release AS VARCHAR) AS j_days_to_release FROM gm""", "gm")

ORACLES["load_stats"] = sql(f"""
SELECT CAST(count(*) AS BIGINT) AS fetched,
  CAST(count(*) FILTER (WHERE {_OK}) AS BIGINT) AS sent,
  CAST(count(*) FILTER (WHERE NOT ({_OK})) AS BIGINT) AS failed FROM games""", "games")

ORACLES["fill_defaults"] = sql(f"""
SELECT id, hypes, follows, rating_count, franchise_count, platform_count, genre_count,
  {r6('total_rating')} AS total_rating, {r6('aggregated_rating')} AS aggregated_rating
FROM gfill""", "gfill")

CTES_DOCS = f"""
SELECT *, ((CAST(hypes > 0 AS INTEGER) + CAST(follows > 0 AS INTEGER)
   + CAST(rating_count > 0 AS INTEGER) + CAST(franchise_count > 0 AS INTEGER)
   + CAST(platform_count > 0 AS INTEGER) + CAST(genre_count > 0 AS INTEGER)) / {D(6.0)}
  + CASE WHEN community_data_volume >= 50 THEN {D(0.15)}
         WHEN community_data_volume >= 20 THEN {D(0.10)}
         WHEN community_data_volume >= 5 THEN {D(0.05)} ELSE {D(0.0)} END) * 100
  AS prediction_confidence
FROM community"""
from .oracle import CTES  # noqa: E402
CTES["scored"] = (CTES_DOCS, ["community"])

ORACLES["confidence"] = sql(f"""
SELECT id, community_data_volume, {r6('prediction_confidence')} AS prediction_confidence
FROM scored""", "scored")

ORACLES["success_score"] = sql(f"""
SELECT id, success_level, CAST(success_level * {D(50.0)} AS DOUBLE) AS success_score
FROM gm""", "gm")

_DOC_ROUNDED = ["rating", "total_rating", "aggregated_rating", "genre_popularity_score",
                "platform_reach_score", "hype_score", "longevity_score",
                "community_sentiment_score", "prediction_confidence"]
_DOC_ARRAYS = ["genres", "platforms", "game_modes", "themes", "player_perspectives"]
ORACLES["document_projection"] = sql(
    f"""SELECT id AS game_id, name, rating_count, hypes, follows,
  release_date_formatted AS release_date, days_to_release, days_since_release,
  is_released, is_upcoming, franchise_count, platform_count, genre_count, success_level,
  community_sentiment_label, community_data_volume, sentiment_source,
  CAST(NULL AS DOUBLE) AS predicted_rating, CAST(NULL AS DOUBLE) AS predicted_rating_count,
  CAST(NULL AS DOUBLE) AS predicted_longevity, CAST(NULL AS DOUBLE) AS predicted_success_class,
  CAST(NULL AS DOUBLE) AS predicted_success_score,
  CAST(7 AS BIGINT) AS batch_id, CAST({C.AS_OF_EPOCH} AS BIGINT) AS processed_timestamp,
  {q('2000-01-01T12:00:00')} AS ingestion_time, """
    + ", ".join(f"{r6(c)} AS {c}" for c in _DOC_ROUNDED) + ", "
    + ", ".join(f"{joined(a)} AS {a}" for a in _DOC_ARRAYS) + " FROM scored", "scored")

ORACLES["doc_keys"] = sql("""
SELECT id AS game_id, CAST(7 AS BIGINT) AS batch_id, CAST(id AS VARCHAR) || '_7' AS doc_id
FROM games""", "games")

CTES["history"] = (f"""
SELECT id AS game_id, name, rating, coalesce(rating_count, 0) AS rating_count,
  coalesce(total_rating, 0) AS total_rating, coalesce(aggregated_rating, 0) AS aggregated_rating,
  coalesce(hypes, 0) AS hypes, coalesce(follows, 0) AS follows,
  release_date_formatted AS release_date,
  coalesce(days_to_release, 0) AS days_to_release,
  coalesce(days_since_release, 0) AS days_since_release, is_released, is_upcoming,
  coalesce(franchise_count, 0) AS franchise_count,
  coalesce(platform_count, 0) AS platform_count, coalesce(genre_count, 0) AS genre_count,
  coalesce(hype_score, 0) AS hype_score, coalesce(longevity_score, 0) AS longevity_score,
  coalesce(success_level, 0) AS success_level, genres, platforms, game_modes, themes,
  coalesce(community_sentiment_score, {D(50.0)}) AS community_sentiment_score
FROM scored""", ["scored"])

_HIST_ROUNDED = {"rating", "total_rating", "aggregated_rating", "hype_score",
                 "longevity_score", "community_sentiment_score"}
_HIST_COLS = ["game_id", "name", "rating", "rating_count", "total_rating",
              "aggregated_rating", "hypes", "follows", "release_date", "days_to_release",
              "days_since_release", "is_released", "is_upcoming", "franchise_count",
              "platform_count", "genre_count", "hype_score", "longevity_score",
              "success_level", "genres", "platforms", "game_modes", "themes",
              "community_sentiment_score"]
_HIST_ARR = {"genres", "platforms", "game_modes", "themes"}
ORACLES["history_scan"] = sql(
    "SELECT " + ", ".join(f"{r6(c)} AS {c}" if c in _HIST_ROUNDED
                          else (f"{joined(c)} AS {c}" if c in _HIST_ARR else c)
                          for c in _HIST_COLS) + " FROM history", "history")

# the stream's documents where they are newest, else those of a bulk load, which has no sentiment (filled by 50)
CTES["bulk_history"] = (CTES["history"][0].replace(
    f"coalesce(community_sentiment_score, {D(50.0)})", D(50.0)).replace("FROM scored", "FROM gm"), ["gm"])
ORACLES["history_newest"] = sql(
    "SELECT " + ", ".join(f"{r6(c)} AS {c}" if c in _HIST_ROUNDED
                          else (f"{joined(c)} AS {c}" if c in _HIST_ARR else c)
                          for c in _HIST_COLS)
    + " FROM (SELECT * FROM history WHERE game_id % 3 > 0 AND game_id % 4 > 0"
      " UNION ALL SELECT * FROM bulk_history WHERE NOT (game_id % 3 > 0 AND game_id % 4 > 0))", "history", "bulk_history")

_BULK_ARRAYS = ["franchises", "genre_ids", "platform_ids", "theme_ids", "game_mode_ids",
                "player_perspective_ids", "involved_companies", "screenshots", "videos", "artworks",
                "websites", "similar_games", "expansions", "bundles"]
_BULK_NAMES = ["genres", "platforms", "game_modes", "themes", "player_perspectives"]
ORACLES["bulk_metrics"] = sql(f"""
SELECT id AS game_id, name, release_date_formatted, days_since_release, days_to_release,
  is_released, is_upcoming, franchise_count, platform_count, genre_count, company_count,
  video_count, screenshot_count, website_count, marketing_intensity,
  {r6('hype_score')} AS hype_score, {r6('longevity_score')} AS longevity_score,
  success_level, has_multiplayer, has_expansions, first_release_date AS release_date,
  {q('2000-01-01T12:00:00')} AS ingestion_time,
  CAST({C.AS_OF_EPOCH} AS BIGINT) AS processed_timestamp,
  coalesce(hypes, 0) AS hypes, coalesce(follows, 0) AS follows, category, status,
  rating_count, total_rating_count, aggregated_rating_count, {r6('rating')} AS rating,
  {r6('total_rating')} AS total_rating, {r6('aggregated_rating')} AS aggregated_rating,
  CAST(id AS VARCHAR) || '_{C.AS_OF_EPOCH}' AS doc_id, """
    + ", ".join([f"{joined(f'coalesce({c}, []::INTEGER[])')} AS {c}" for c in _BULK_ARRAYS]
                + [f"{joined(c)} AS {c}" for c in _BULK_NAMES]) + " FROM gm", "gm")

# ---------------------------------------------------------------- training
ORACLES["train_counts"] = sql("""
SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(count(*) FILTER (WHERE rating IS NOT NULL) AS BIGINT) AS n_rating,
  CAST(count(*) FILTER (WHERE rating IS NOT NULL) AS BIGINT) AS n_rating_base,
  CAST(count(*) FILTER (WHERE rating_count IS NOT NULL AND rating_count > 0) AS BIGINT)
    AS n_rating_count,
  CAST(count(*) FILTER (WHERE longevity_score IS NOT NULL) AS BIGINT) AS n_longevity,
  CAST(count(*) FILTER (WHERE success_level IS NOT NULL) AS BIGINT) AS n_success
FROM history""", "history")

ORACLES["feature_rows"] = sql(f"""
SELECT id, {r6(f'''{D(0.0)} + hypes + follows + rating_count + franchise_count + platform_count
  + genre_count + total_rating + aggregated_rating''')} AS feature_sum
FROM gm WHERE hypes IS NOT NULL AND follows IS NOT NULL AND rating_count IS NOT NULL
  AND total_rating IS NOT NULL AND aggregated_rating IS NOT NULL""", "gm")

# ---------------------------------------------------------------- TTL memo
ORACLES["sentiment_memo"] = f"""
WITH RECURSIVE ev AS (
  SELECT CAST(user_id % 5 AS INTEGER) AS k, event_id,
    CAST(floor(epoch(ts)) AS BIGINT) AS t, value AS v,
    row_number() OVER (PARTITION BY user_id % 5
                       ORDER BY CAST(floor(epoch(ts)) AS BIGINT), event_id) AS rn
  FROM events),
r(k, rn, event_id, t, anchor_t, memo) AS (
  SELECT k, rn, event_id, t, t, v FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.k, e.rn, e.event_id, e.t,
    CASE WHEN e.t - r.anchor_t < {C.MEMO_TTL_SECONDS} THEN r.anchor_t ELSE e.t END,
    CASE WHEN e.t - r.anchor_t < {C.MEMO_TTL_SECONDS} THEN r.memo ELSE e.v END
  FROM r JOIN ev e ON e.k = r.k AND e.rn = r.rn + 1)
SELECT event_id, k, t, anchor_t AS memo_at, round(memo, 6) AS memo_score FROM r"""

# ---------------------------------------------------------------- more sinks / SQL
ORACLES["decode_quarantine"] = sql(f"""
SELECT {_TS} AS timestamp,
  CASE id % 1000 WHEN 997 THEN 'null' WHEN 998 THEN 'empty' ELSE 'malformed' END AS reason
FROM games WHERE id % 1000 IN (997, 998, 999)""", "games")

ORACLES["sql_list_scores"] = sql(f"""
SELECT id, {r6('genre_popularity_score')} AS genre_popularity_score,
  {r6('platform_reach_score')} AS platform_reach_score FROM gfill""", "gfill")

ORACLES["bulk_import"] = sql(f"""
SELECT id AS game_id, first_release_date AS release_date, days_since_release, is_released,
  is_upcoming, success_level, {r6('hype_score')} AS hype_score,
  {r6('longevity_score')} AS longevity_score, {joined('genres')} AS genres
FROM gm WHERE first_release_date >= {PAGE_BOUND}""", "gm")

ORACLES["crawl_messages"] = sql(f"""
SELECT id, CAST(hypes AS VARCHAR) AS j_hypes, CAST(is_upcoming AS VARCHAR) AS j_is_upcoming,
  {_json_strs('genres')} AS j_genres
FROM gm WHERE id IN {_RECENT_IDS}""", "gm")

def _crawl_mixed_sql() -> str:
    from .oracle import _mixed
    ids, names = _mixed("platforms", C.DIM_PLATFORMS)
    return sql(f"""
SELECT id, genre_count, {_json_strs('m_names')} AS j_platforms,
  '[' || array_to_string(m_ids, ',') || ']' AS j_platform_ids
FROM (SELECT id, {ids} AS m_ids, {names} AS m_names FROM games) JOIN (SELECT id, genre_count FROM gm) USING (id)
WHERE id IN {_RECENT_IDS}""", "gm", "games")


ORACLES["crawl_mixed"] = _crawl_mixed_sql()

ORACLES["stream_roundtrip"] = sql(f"""
SELECT id AS game_id, is_upcoming, {r6('community_sentiment_score')} AS community_sentiment_score,
  {r6('prediction_confidence')} AS prediction_confidence
FROM scored WHERE {_OK}""", "scored")

# values that hold for any data: normal equations, and means within their range
ORACLES["linear_residuals"] = "SELECT " + ", ".join(
    f"{D(0.0)} AS residual_{c}" for c in ["bias", *C.EXTENDED_FEATURES])
ORACLES["forest_ranges"] = ("SELECT CAST(0 AS BIGINT) AS outside_rating_count, "
                            "CAST(0 AS BIGINT) AS outside_longevity")

ORACLES["tree_values"] = sql("""
SELECT model, CAST(count(*) AS BIGINT) AS scored, CAST(0 AS BIGINT) AS differing
FROM history, (VALUES ('rating'), ('rating_base'), ('rating_count'), ('longevity')) m(model)
GROUP BY model""", "history")
ORACLES["tree_leaves"] = sql("""
SELECT model, CAST(count(*) AS BIGINT) AS reached, CAST(0 AS BIGINT) AS differing
FROM history, (VALUES ('rating'), ('rating_base')) m(model)
WHERE rating IS NOT NULL GROUP BY model""", "history")
ORACLES["logistic_values"] = sql(f"""
SELECT CAST(count(*) AS BIGINT) AS scored, CAST(0 AS BIGINT) AS differing,
  CAST(count(success_level) AS BIGINT) AS trained_on, {D(0.0)} AS loss_apart
FROM history""", "history")

ORACLES["sentiment_memo_by_key"] = sql(f"""
SELECT event_id, k, t, anchor_t AS memo_at, round(memo, 6) AS memo_score FROM r""", "gm").replace(
    "WITH ", "WITH RECURSIVE ", 1).replace("\nSELECT event_id, k, t, anchor_t", f""",
ev AS (
  SELECT k, event_id, t, v, row_number() OVER (PARTITION BY k ORDER BY t, event_id) AS rn
  FROM (SELECT name || '_' || CAST(CAST(floor(days_to_release / {D(7)}) AS BIGINT) AS VARCHAR) AS k,
          event_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, value AS v
        FROM events JOIN gm ON user_id = id
        WHERE is_upcoming AND days_to_release BETWEEN 1 AND 365)),
r(k, rn, event_id, t, anchor_t, memo) AS (
  SELECT k, rn, event_id, t, t, v FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.k, e.rn, e.event_id, e.t,
    CASE WHEN e.t - r.anchor_t < {C.MEMO_TTL_SECONDS} THEN r.anchor_t ELSE e.t END,
    CASE WHEN e.t - r.anchor_t < {C.MEMO_TTL_SECONDS} THEN r.memo ELSE e.v END
  FROM r JOIN ev e ON e.k = r.k AND e.rn = r.rn + 1)
SELECT event_id, k, t, anchor_t""", 1)
