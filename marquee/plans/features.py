"""Stored user features from a full history, as the batch counterpart of the ingestion stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from marquee.operators import features
from marquee.session import materialize


@dataclass
class UserFeatures:
    recent: DataFrame
    watched: DataFrame
    affinity: DataFrame


def user_features(events: DataFrame, items: DataFrame, recent_kept: int = 20) -> UserFeatures:
    """Read the events once, keep the per-title summary, derive all user features from it."""
    summary = materialize(features.user_item_summary(events, items), "summary")
    return UserFeatures(
        recent=materialize(features.recent_items(features.last_seen(summary), recent_kept), "recent"),
        watched=materialize(features.watched_items(summary), "watched"),
        affinity=materialize(features.genre_affinity(summary, items), "affinity"),
    )
