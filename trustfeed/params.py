"""Parameters of every stage, as frozen dataclasses.

FIXED VALUES: the numbers below must equal the behaviour being reproduced
(thresholds, weights, caps, bucket bounds, default cursors, label names).
They are stated here once, in natural order, and every operator takes them
as arguments so that a caller can override any of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------- fixed values
# Default cursors of the first run.
DEFAULT_EXTRACT_WATERMARK = "2022-05-01 00:00:00"   # block_timestamp, UTC, strict >
DEFAULT_PARTITION_WATERMARK = 20230515000000         # dtime, strict >

# Trust strategy whose newest snapshot is ranked.
TRUST_STRATEGY = "followship"

# Post score: weight per normalised counter, divisor when a maximum is not > 0.
SCORE_WEIGHTS = {"mirrors": 1.0, "collects": 1.0, "comments": 3.0, "age": -5.0}
SCORE_ZERO_DIVISOR = 1e10

# Heuristic labels: rank <= yes_rank gives MAYBE, the best top_k of those posts
# by score are YES, rank >= no_rank gives NO.
LABEL_YES_RANK = 1000
LABEL_NO_RANK = 50000
LABEL_TOP_K = 1000
LABELS = ("MAYBE", "NO", "YES")            # sorted order used for the 0..2 codes

# Engagement score weights: upvotes, mirrors, comments, collects.
ENGAGEMENT_WEIGHTS = {"upvotes": 1, "mirrors": 3, "comments": 5, "collects": 7}
ENGAGEMENT_WEIGHTS_PROTOTYPE = {"upvotes": 1, "mirrors": 3, "comments": 5, "collects": 0}

# Recency buckets: (name, exclusive upper bound in seconds); last bucket open.
RECENCY_BUCKETS = (("1d", 86400), ("1w", 604800), ("4w", 2419200), ("99w", None))
RECENCY_BUCKETS_PROTOTYPE = (("1d", 86400), ("7d", 604800), ("30d", 2592000), ("99d", None))

# Per-bucket sample caps and final feed size.
BUCKET_CAPS = {"1d": 5000, "1w": 1000, "4w": 1000, "99w": 1000}
BUCKET_CAPS_PROTOTYPE = {"1d": 100, "7d": 50, "30d": 50, "99d": 50}
FEED_SIZE = 2000
FEED_SIZE_PROTOTYPE = 100

# Popularity labels from lowest to highest tercile.
POPULARITY_LABELS = ("C", "B", "A")

# Feed weight profiles.
#   v2 (live): A&YES .75, A&MAYBE .1, everything else .15
#   v1: YES&A .4, YES&B .3, YES&C .1, MAYBE .2
FEED_WEIGHTS_V2 = {"A_YES": 0.75, "A_OTHER": 0.1, "OTHER": 0.15}
FEED_WEIGHTS_V1 = {"YES_A": 0.4, "YES_B": 0.3, "YES_C": 0.1, "OTHER": 0.2}

FEED_STRATEGY = "ml-xgb-followship"

# Rank fill for unranked profiles before prediction output, numeric fill, text fill.
FILL_RANK = 1e10

# Currency label of collect modules.
MATIC_CONTRACT = "0x0d500B1d8E8eF31E21C99d1Db9A6444d3ADf1270"
CURRENCY_SCALE = 1e18

# Stratified preview sample: expected rows per label.
STRATIFIED_TARGETS = {"YES": 80, "MAYBE": 20}
# Train/test split share and seed.
TEST_FRACTION = 0.25
SPLIT_SEED = "1"
# Boosting rounds, trees of the forest, their depth, and rounds between loss reports.
BOOSTING_ROUNDS = 100
FOREST_TREES = 100
BOOSTING_DEPTH = 4
FOREST_DEPTH = 6
LOSS_EVERY = 10
# Training rows are dealt by key to partitions of about this many rows and sorted, so that a
# fitted model depends on the rows alone, not on the cluster or on how its input was split.
TRAIN_PARTITION_ROWS = 20_000
# ----------------------------------------------------------- end fixed values


@dataclass(frozen=True)
class LabelParams:
    yes_rank: int = LABEL_YES_RANK
    no_rank: int = LABEL_NO_RANK
    top_k: int = LABEL_TOP_K


@dataclass(frozen=True)
class FeedParams:
    strategy_name: str = FEED_STRATEGY
    engagement_weights: dict = field(default_factory=lambda: dict(ENGAGEMENT_WEIGHTS))
    buckets: tuple = RECENCY_BUCKETS
    caps: dict = field(default_factory=lambda: dict(BUCKET_CAPS))
    feed_size: int = FEED_SIZE
    weight_profile: str = "v2"
    recency_mode: str = "elapsed"          # or "packed" (original integer arithmetic)
    require_engagement: bool = True
    seed: str = "feed"
    latest_per_post: bool = True

    @staticmethod
    def prototype() -> "FeedParams":
        return FeedParams(
            engagement_weights=dict(ENGAGEMENT_WEIGHTS_PROTOTYPE),
            buckets=RECENCY_BUCKETS_PROTOTYPE,
            caps=dict(BUCKET_CAPS_PROTOTYPE),
            feed_size=FEED_SIZE_PROTOTYPE,
            weight_profile="v1",
            require_engagement=False,
        )
