"""Regional trending titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.weights import interaction_weight


def last_hours(events: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Events not older than ``hours`` before ``as_of``; there is no upper bound."""
    return events.filter(F.col("event_ts") >= as_of - F.expr(f"INTERVAL {int(hours)} HOURS"))


def trending_scores(events: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    weight = interaction_weight(F.col("event_type"), F.col("completion_pct"))
    return last_hours(events, as_of, hours).groupBy("region", "item_id").agg(F.sum(weight).alias("weight"))


def trending_items(events: DataFrame, as_of: Column, top_n: int = 10, hours: int = 24) -> DataFrame:
    window = Window.partitionBy("region").orderBy(F.col("weight").desc(), F.col("item_id"))
    return (
        trending_scores(events, as_of, hours)
        .withColumn("position", F.row_number().over(window))
        .filter(F.col("position") <= top_n)
        .select("region", "item_id", F.round(F.col("weight").cast("double"), 6).alias("score"))
    )
