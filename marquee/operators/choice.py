"""Taste-driven scores and weighted choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.scoring import deterministic_score, weighted_choice_key
from marquee.functions.text import csv_list


def cold_start_scores(pairs: DataFrame, priors: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, item_id, score) for the given pairs: 1, plus the user's prior of each genre of the
    title, plus 0.3 per release year after 2022."""
    facts = items.select("item_id", csv_list(F.col("genres")).alias("genre_list"), "release_year")
    genres = pairs.join(facts, "item_id").select(
        "user_id", "item_id", "release_year", F.explode("genre_list").alias("genre")
    )
    newness = F.greatest(F.lit(0), F.col("release_year") - 2022) * F.lit(0.3)
    return (
        genres.join(priors, ["user_id", "genre"], "left")
        .groupBy("user_id", "item_id", "release_year")
        .agg(F.coalesce(F.sum("prior"), F.lit(0)).alias("taste"))
        .select("user_id", "item_id", F.round(F.lit(1.0) + F.col("taste") + newness, 6).alias("score"))
    )


def with_holdout(rows: DataFrame, *keys: str, share: float = 0.2) -> DataFrame:
    """Rows with ``held_out``, true for a fixed share of the keys; every row of a key falls on the same side."""
    return rows.withColumn("held_out", deterministic_score(*[F.col(key) for key in keys]) < F.lit(share))


def weighted_choice(weighted: DataFrame, group: str, item: str, weight: str, size: int = 1) -> DataFrame:
    """``size`` draws per group without replacement, each with probability proportional to the weight.

    The draw is a function of the ids, so every run and every retry of a task chooses the same rows.
    """
    uniform = deterministic_score(F.col(group), F.col(item))
    window = Window.partitionBy(group).orderBy(F.col("_key").desc(), item)
    return (
        weighted.withColumn("_key", weighted_choice_key(uniform, F.col(weight)))
        .withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= size).drop("_key", "_n")
    )
