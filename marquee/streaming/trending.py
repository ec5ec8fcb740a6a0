"""Trending titles of a running ingestion: hourly panes that slide into the window.

Every batch adds the weights of its facts to panes of one hour, per region and title. A window is made of the whole panes
inside it and of the facts in the pane where it starts, so it is exact to the microsecond while only sums are kept. The
window ends with the newest event; panes that start more than an hour before it can never count again, and a compaction
drops them, so their number is bounded by the hours of the window and not by the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.weights import interaction_weight

HOURS = 24
TOP = 10
SUM_TYPE = "decimal(18,6)"


def panes(facts: DataFrame) -> DataFrame:
    """(pane, region, item_id, weight, latest): the weights of each hour, with the newest event in them."""
    weight = interaction_weight(F.col("event_type"), F.col("completion_pct"))
    return facts.groupBy(F.date_trunc("hour", "event_ts").alias("pane"), "region", "item_id").agg(
        F.sum(weight).cast(SUM_TYPE).alias("weight"), F.max("event_ts").alias("latest")
    )


def merged_panes(parts: DataFrame, hours: int = HOURS) -> DataFrame:
    """Panes of several batches as one, without those that no window reaches any more."""
    newest = parts.agg(F.max("latest")).scalar()
    in_reach = parts.withColumn("newest", newest).filter(F.col("pane") > F.col("newest") - F.expr(f"INTERVAL {hours + 1} HOURS"))
    return in_reach.groupBy("pane", "region", "item_id").agg(
        F.sum("weight").cast(SUM_TYPE).alias("weight"), F.max("latest").alias("latest")
    )


def window_sums(panes: DataFrame, facts: DataFrame, hours: int = HOURS) -> DataFrame:
    """(region, item_id, weight) of the ``hours`` before the newest event, which is part of the window.

    ``facts`` are read only in the hour where the window starts.
    """
    as_of = panes.agg(F.max("latest")).scalar()
    start = as_of - F.expr(f"INTERVAL {hours} HOURS")
    # The first whole pane; a window that starts on the hour has no other.
    first = F.date_trunc("hour", start)
    whole = F.when(first == start, first).otherwise(first + F.expr("INTERVAL 1 HOUR"))
    stamp = F.col("event_ts").cast(panes.schema["latest"].dataType)
    edge = facts.filter(F.col("event_date").between(F.to_date(start), F.to_date(whole))).filter((stamp >= start) & (stamp < whole))
    weight = interaction_weight(F.col("event_type"), F.col("completion_pct"))
    parts = panes.filter(F.col("pane") >= whole).select("region", "item_id", "weight").unionByName(
        edge.groupBy("region", "item_id").agg(F.sum(weight).cast(SUM_TYPE).alias("weight"))
    )
    return parts.groupBy("region", "item_id").agg(F.sum("weight").cast(SUM_TYPE).alias("weight"))


def top_titles(sums: DataFrame, top: int = TOP) -> DataFrame:
    """The best titles of each region, as ``operators.trending.trending_items`` gives them."""
    order = Window.partitionBy("region").orderBy(F.desc("weight"), "item_id")
    best = sums.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= top)
    return best.select("region", "item_id", F.round(F.col("weight").cast("double"), 6).alias("score"))

