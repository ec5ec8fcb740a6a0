"""Operational aggregates over event and serving logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds in seconds of the default latency histogram.
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def _bucket_start(stamp: str, width: str) -> Column:
    return F.window(stamp, width)["start"].alias("window_start")


def per_window(events: DataFrame, stamp: str, width: str = "1 minute", by: tuple[str, ...] = ()) -> DataFrame:
    """Rows per tumbling window, optionally by further columns."""
    return events.groupBy(_bucket_start(stamp, width), *by).agg(F.count("*").alias("n"))


def latency_quantile(log: DataFrame, stamp: str, latency: str, q: float = 0.95, width: str = "5 minutes") -> DataFrame:
    """Quantile per window from a cumulative histogram, linear inside a bucket.

    Rows are reduced to the bucket counts of a window before the shuffle. Above the last bound the
    last bound is reported.
    """
    within = [F.sum((F.col(latency) <= bound).cast("int")) for bound in LATENCY_BUCKETS]
    counts = log.groupBy(_bucket_start(stamp, width)).agg(
        F.count("*").alias("n"), F.array(*within).alias("at_most")
    )
    rank = F.col("n") * F.lit(q)
    value = F.lit(LATENCY_BUCKETS[-1])
    for i in reversed(range(len(LATENCY_BUCKETS))):
        low = LATENCY_BUCKETS[i - 1] if i else 0.0
        below = F.get("at_most", F.lit(i - 1)) if i else F.lit(0)
        reached = F.get("at_most", F.lit(i))
        inside = F.lit(low) + F.lit(LATENCY_BUCKETS[i] - low) * (rank - below) / (reached - below)
        value = F.when(reached >= rank, inside).otherwise(value)
    return counts.select("window_start", F.round(value, 6).alias("latency"))


def mean_candidates(matrix: DataFrame) -> DataFrame:
    """Mean number of merged candidates per user, counted before the guardrails."""
    per_user = matrix.groupBy("user_id").agg(F.count("*").alias("candidates"))
    return per_user.agg(F.round(F.avg("candidates"), 6).alias("mean_candidates"))


def active_users(events: DataFrame, stamp: str, width: str = "1 hour") -> DataFrame:
    """Distinct users per window. Repeats are dropped before the shuffle and the distinct users of a
    window are counted in parallel."""
    seen = events.select(_bucket_start(stamp, width), "user_id").distinct()
    return seen.groupBy("window_start").agg(F.count("*").alias("users"))
