"""Weight tables and the expressions that apply them.

Weights are decimals, so sums do not depend on the order in which partitions are added up.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Training weight per event type, and the weight of any other type.
TRAINING_WEIGHTS = {
    "impression": "0.2",
    "click": "0.5",
    "play_start": "1.0",
    "watch_progress": "1.5",
    "complete": "2.2",
    "watchlist_add": "0.8",
}
# Online feature increment per event type.
ONLINE_INCREMENTS = {
    "impression": "0.1",
    "click": "0.3",
    "play_start": "0.8",
    "watch_progress": "1.2",
    "complete": "2.0",
    "watchlist_add": "0.5",
}
OTHER_EVENT_WEIGHT = "0.1"

# Event types that count as engagement, and those that play the title.
ENGAGEMENT_TYPES = ("play_start", "watch_progress", "complete", "watchlist_add", "click")
PLAY_TYPES = ("play_start", "watch_progress", "complete")

# Blend weights. The order also decides ties between reasons.
BLEND_WEIGHTS = {
    "collaborative": 0.35,
    "content": 0.25,
    "session": 0.20,
    "trending": 0.10,
    "freshness": 0.05,
    "genre_bonus": 0.05,
}

# Maturity levels, with the level of an unlisted item and an unlisted user rating.
MATURITY_LEVELS = {"G": 0, "PG": 1, "PG-13": 2, "R": 3}
UNLISTED_ITEM_LEVEL = 0
UNLISTED_USER_LEVEL = 2

WEIGHT_TYPE = "decimal(18,6)"
TOTAL_TYPE = "decimal(22,6)"
MOST_PERCENT = 1e15


def _lookup(column: Column, table: dict[str, str], other: str) -> Column:
    expr = F.lit(Decimal(other))
    for name, weight in table.items():
        expr = F.when(column == name, F.lit(Decimal(weight))).otherwise(expr)
    return expr.cast(WEIGHT_TYPE)


def interaction_weight(event_type: Column, completion_pct: Column) -> Column:
    """Training weight: base weight of the type plus the completed fraction.

    Total for every double: percentages beyond ``MOST_PERCENT`` either way count as that, NaN as 0. The type
    leaves room for the sum over all events.
    """
    limit = F.lit(MOST_PERCENT)
    bounded = F.when(F.isnan(completion_pct), 0.0).otherwise(F.greatest(F.least(completion_pct, limit), -limit))
    fraction = bounded.cast("decimal(20,4)") * F.lit(Decimal("0.01"))
    return (_lookup(event_type, TRAINING_WEIGHTS, OTHER_EVENT_WEIGHT) + fraction).cast(TOTAL_TYPE)


def online_increment(event_type: Column) -> Column:
    return _lookup(event_type, ONLINE_INCREMENTS, OTHER_EVENT_WEIGHT)


def is_engagement(event_type: Column) -> Column:
    return event_type.isin(*ENGAGEMENT_TYPES)


def is_watched(event_type: Column, completion_pct: Column, watch_seconds: Column) -> Column:
    """A play counts as watched from 5 % or 120 s on, a completion always."""
    enough = (completion_pct >= 5.0) | (watch_seconds >= 120) | (event_type == "complete")
    return event_type.isin(*PLAY_TYPES) & enough


def maturity_level(rating: Column, unlisted: int) -> Column:
    expr = F.lit(unlisted)
    for name, level in MATURITY_LEVELS.items():
        expr = F.when(rating == name, F.lit(level)).otherwise(expr)
    return expr


def completion_percent(event_type: Column, item_type: Column, watch_seconds: Column) -> Column:
    """Watched share of the runtime (45 min for a series, 110 min otherwise), 0 unless a play event."""
    runtime = F.when(item_type == "series", 2700).otherwise(6600)
    share = F.least(F.lit(100.0), watch_seconds / runtime * 100.0)
    return F.when(event_type.isin(*PLAY_TYPES), F.round(share, 2)).otherwise(F.lit(0.0))
