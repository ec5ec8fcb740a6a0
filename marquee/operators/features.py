"""User and region features from interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import weights
from marquee.functions.text import csv_list


def known_events(events: DataFrame, items: DataFrame) -> DataFrame:
    """Events on titles of the catalog, active or not."""
    return events.join(items.select("item_id"), "item_id", "left_semi")


def titled_events(events: DataFrame, items: DataFrame, columns: tuple[str, ...] = ("title", "genres")) -> DataFrame:
    """Events on titles of the catalog with facts of the title; other events are left out."""
    return events.join(items.select("item_id", *columns), "item_id")


def user_item_summary(events: DataFrame, items: DataFrame) -> DataFrame:
    """One row per (user, known title): last event, whether it counts as watched, summed increment.

    All three user features come from this one pass over the events. Rows are combined before the
    shuffle, so neither a busy user nor a popular title moves more than one row per task, and the
    catalog is joined after the reduction.
    """
    watched = weights.is_watched(F.col("event_type"), F.col("completion_pct"), F.col("watch_seconds"))
    summary = events.groupBy("user_id", "item_id").agg(
        F.max("event_ts").alias("last_ts"),
        F.max(F.coalesce(watched, F.lit(False)).cast("int")).alias("watched"),
        F.sum(weights.online_increment(F.col("event_type"))).alias("increment"),
    )
    return known_events(summary, items)


def last_seen(summary: DataFrame) -> DataFrame:
    return summary.select("user_id", "item_id", "last_ts")


def recent_items(seen: DataFrame, limit: int = 20) -> DataFrame:
    """The titles a user touched last, newest first; ``position`` counts from 1."""
    window = Window.partitionBy("user_id").orderBy(F.col("last_ts").desc(), F.col("item_id").desc())
    return seen.withColumn("position", F.row_number().over(window)).filter(F.col("position") <= limit)


def watched_items(summary: DataFrame) -> DataFrame:
    return summary.filter("watched = 1").select("user_id", "item_id")


def genre_affinity(summary: DataFrame, items: DataFrame) -> DataFrame:
    """Summed increments per (user, genre); each genre of a title receives the full increment."""
    genres = items.select("item_id", csv_list(F.col("genres")).alias("genre_list"))
    return (
        summary.select("user_id", "item_id", "increment")
        .join(genres, "item_id")
        .select("user_id", F.explode("genre_list").alias("genre"), "increment")
        .groupBy("user_id", "genre")
        .agg(F.sum("increment").cast(weights.WEIGHT_TYPE).alias("affinity"))
    )


def regional_popularity(events: DataFrame, items: DataFrame) -> DataFrame:
    sums = events.groupBy("region", "item_id").agg(
        F.sum(weights.online_increment(F.col("event_type"))).cast(weights.WEIGHT_TYPE).alias("popularity")
    )
    return known_events(sums, items)
