"""Fixed values.

Everything in the first block must equal the values the original pipeline
uses, or the derived scores change; they are listed plainly, in their natural
order.  The second block holds the fixture conventions of this repository.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original pipeline for equal results)
# ---------------------------------------------------------------------------

SECONDS_PER_DAY = 86400
DAYS_PER_YEAR = 365.0

# hype score
HYPE_WEIGHT = 2.0
FOLLOW_WEIGHT = 1.5
ANTICIPATION_WEIGHT = 0.5
HYPE_HORIZON_DAYS = 365
HYPE_FAR_FACTOR = 0.3
HYPE_DIVISOR = 10.0
SCORE_CAP = 100.0

# longevity score
QUALITY_WEIGHT = 40
POPULARITY_WEIGHT = 30
FRANCHISE_WEIGHT = 15
PLATFORM_WEIGHT = 10
AGE_WEIGHT = 5
POPULARITY_FULL_AT = 1000.0
FRANCHISE_FULL_AT = 5.0
PLATFORM_FULL_AT = 10.0
AGE_FULL_AT_YEARS = 10.0
YOUNG_AGE_FACTOR = 0.5

# success level: (level, min rating, min rating count), checked in order
SUCCESS_TIERS = [(2, 80, 500), (1, 60, 100)]
SUCCESS_FLOOR = 0

# genre popularity: mean weight x 50, capped at 100
GENRE_WEIGHTS = {
    "Action": 1.2, "RPG": 1.15, "Adventure": 1.1, "Strategy": 1.0,
    "Shooter": 1.1, "Fighting": 0.9, "Racing": 0.85, "Sports": 0.9,
    "Simulator": 0.8, "Indie": 0.75, "Puzzle": 0.7, "Platform": 0.9,
}
GENRE_DEFAULT_WEIGHT = 0.7
GENRE_SCALE = 50.0

# platform reach: sum weight x 25, capped at 100
PLATFORM_WEIGHTS = {
    "PC (Microsoft Windows)": 1.0, "PlayStation 5": 1.2, "Xbox Series X|S": 1.1,
    "Nintendo Switch": 1.15, "PlayStation 4": 0.9, "Xbox One": 0.85,
    "iOS": 0.7, "Android": 0.7, "Mac": 0.6, "Linux": 0.5,
}
PLATFORM_DEFAULT_WEIGHT = 0.5
PLATFORM_SCALE = 25.0

# post sentiment
POSITIVE_KEYWORDS = [
    "amazing", "great", "awesome", "love", "excited", "hyped",
    "fantastic", "incredible", "best", "perfect", "masterpiece",
    "brilliant", "stunning", "epic",
]
NEGATIVE_KEYWORDS = [
    "bad", "terrible", "awful", "hate", "disappointed", "boring",
    "worst", "trash", "garbage", "disaster", "failure",
    "broken", "buggy", "mess",
]
POSTS_SCORED = 50
# post vote tiers: (strictly above, value); then below -10 -> -0.5; else 0
POST_SCORE_TIERS = [(100, 1.0), (50, 0.5), (10, 0.2)]
POST_SCORE_LOW = (-10, -0.5)
KEYWORD_WEIGHT = 0.6
VOTE_WEIGHT = 0.4

# label thresholds: (posts and final blend) and (reviews)
LABEL_POSITIVE_AT = 60
LABEL_NEUTRAL_AT = 40
REVIEW_POSITIVE_AT = 75
REVIEW_NEUTRAL_AT = 50
REVIEW_SCALE = 10.0

# source blend weights, in source order
SOURCE_WEIGHTS = [("reddit", 0.4), ("metacritic", 0.3), ("igdb", 0.3)]
NEUTRAL_SCORE = 50.0
NEUTRAL_LABEL = "neutral"

# native engagement score
NATIVE_HYPES_FULL = 100.0
NATIVE_FOLLOWS_FULL = 1000.0
NATIVE_SCALE = 50.0

# upcoming gate for sentiment (caller's gate: 1..365 days ahead)
SENTIMENT_MIN_DAYS = 1
SENTIMENT_MAX_DAYS = 365
MEMO_WEEK_DAYS = 7
MEMO_TTL_SECONDS = 3600

# prediction confidence boost by community volume: (at least, boost)
CONFIDENCE_BOOSTS = [(50, 0.15), (20, 0.10), (5, 0.05)]
SUCCESS_SCORE_PER_CLASS = 50.0

# review page: user-score block
REVIEW_SCORE_CLASS = "c-siteReviewScore_user"

# preview lines
PREVIEW_ROWS = 3
PREVIEW_ITEMS = 2
PREVIEW_EMPTY = "N/A"

# crawl / bulk defaults
RECENT_WINDOW_DAYS = 60
RECENT_TOP_K = 100
BULK_PAGE_SIZE = 500
BULK_LOWER_BOUND = "2005-01-01 00:00:00"

# ML
MODEL_REFRESH_SECONDS = 3600
MIN_TRAIN_ROWS = 100
BASE_FEATURES = ["hypes", "follows", "rating_count", "franchise_count",
                 "platform_count", "genre_count"]
EXTENDED_FEATURES = BASE_FEATURES + ["total_rating", "aggregated_rating"]
SENTIMENT_FEATURES = EXTENDED_FEATURES + ["community_sentiment_score"]

# null fills before scoring (stream) and before training (history)
STREAM_FILLS = {
    "hypes": 0, "follows": 0, "rating_count": 0,
    "franchise_count": 0, "platform_count": 0, "genre_count": 0,
    "total_rating": 0, "aggregated_rating": 0,
}
HISTORY_FILLS = {
    "hypes": 0, "follows": 0, "rating_count": 0,
    "franchise_count": 0, "platform_count": 0, "genre_count": 0,
    "total_rating": 0, "aggregated_rating": 0,
    "days_to_release": 0, "days_since_release": 0,
    "hype_score": 0, "longevity_score": 0, "success_level": 0,
    "community_sentiment_score": 50.0,
}

# ---------------------------------------------------------------------------
# Fixture conventions of this repository (not from the original pipeline)
# ---------------------------------------------------------------------------

# reference instant for fixtures: 2000-01-01 12:00:00 UTC
AS_OF_EPOCH = 946728000
# posts are dated January 2024; their month window ends here
POSTS_AS_OF = "2024-01-20 00:00:00"
POSTS_WINDOW_DAYS = 30

# dimension names, by id (genre and platform names follow the weight tables)
DIM_GENRES = list(GENRE_WEIGHTS)
DIM_PLATFORMS = list(PLATFORM_WEIGHTS)
DIM_GAME_MODES = ["Single player", "Multiplayer", "Co-operative",
                  "Split screen", "Massively Multiplayer Online (MMO)"]
DIM_THEMES = ["Fantasy", "Science fiction", "Horror", "Open world"]
DIM_PERSPECTIVES = ["First person", "Third person", "Bird view / Isometric"]

# id modulus per array in the games fixture (one beyond the dimension size
# on genres and platforms so unknown ids occur)
GENRE_MOD = 13
PLATFORM_MOD = 11
FRANCHISE_MOD = 7
GAME_MODE_MOD = 6
THEME_MOD = 5
PERSPECTIVE_MOD = 3
