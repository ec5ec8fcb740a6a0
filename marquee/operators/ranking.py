"""Guardrails, blending, diversity and the final cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import scoring
from marquee.functions.text import csv_list
from marquee.functions.weights import BLEND_WEIGHTS

PER_LEAD_GENRE = 2
MAX_LIMIT = 25


def unwatched(matrix: DataFrame, watched: DataFrame) -> DataFrame:
    return matrix.join(watched.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def with_known_titles(matrix: DataFrame) -> DataFrame:
    """Candidates that are active catalog titles, with the facts as columns."""
    return matrix.filter(F.col("facts").isNotNull() & F.col("facts.is_active")).select(
        "*", "facts.*"
    ).drop("facts", "is_active")


def pass_guardrails(matrix: DataFrame, strict_regions: bool = False) -> DataFrame:
    """Titles the user may see; expects the user's ``region`` and ``user_rating`` on the row."""
    return matrix.filter(
        scoring.available_in(F.col("region"), F.col("available_regions"), strict_regions)
        & scoring.suitable_for(F.col("maturity_rating"), F.col("user_rating"))
    )


def affinity_maps(affinity: DataFrame) -> DataFrame:
    """One row per user; the map has one entry per genre of the catalog at most."""
    return affinity.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("genre", "affinity"))).alias("taste")
    )


def with_genre_bonus(matrix: DataFrame) -> DataFrame:
    """Expects ``genres`` and the user's ``taste`` map on the row."""
    zero = F.lit(0).cast("decimal(18,6)")
    total = F.aggregate(
        csv_list(F.col("genres")), zero,
        lambda so_far, genre: (so_far + F.coalesce(F.try_element_at("taste", genre), zero)).cast("decimal(18,6)"),
    )
    return matrix.withColumn("genre_bonus", scoring.genre_bonus(total))


def blended(matrix: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    return (
        with_genre_bonus(matrix)
        .withColumn("freshness", scoring.freshness(F.col("release_year")))
        .withColumn("blend", scoring.blended_score(weights))
        .withColumn("reason", scoring.reason())
    )


def diverse(scored: DataFrame, per_genre: int = PER_LEAD_GENRE) -> DataFrame:
    """At most ``per_genre`` titles of one lead genre per user, best first."""
    lead = F.trim(F.get(F.split("genres", ","), F.lit(0)))
    window = Window.partitionBy("user_id", "lead_genre").orderBy(F.col("blend").desc(), "item_id")
    return (
        scored.withColumn("lead_genre", lead)
        .withColumn("genre_position", F.row_number().over(window))
        .filter(F.col("genre_position") <= per_genre)
    )


def best(scored: DataFrame, limit: int = 10) -> DataFrame:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be 1 to {MAX_LIMIT}")
    window = Window.partitionBy("user_id").orderBy(F.col("blend").desc(), "item_id")
    return scored.withColumn("position", F.row_number().over(window)).filter(F.col("position") <= limit)


def served(ranked: DataFrame) -> DataFrame:
    """Columns and rounding of a served recommendation."""
    return ranked.select(
        "user_id", "position", "item_id", "title", "genres", F.round("blend", 4).alias("score"), "reason",
        *[F.round(name, 4).alias(name) for name in BLEND_WEIGHTS],
    )
