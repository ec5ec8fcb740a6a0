"""Training: neighbours, trending titles and the version record, published together."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schema
from marquee.functions.scoring import model_version_id
from marquee.operators import content, covisit, trending
from marquee.plans.recommend import latest_version
from marquee.session import exists

DESCRIPTION = "co-occurrence + tfidf hybrid"


@dataclass
class TrainedTables:
    neighbors: DataFrame
    trending: DataFrame


def train(items: DataFrame, interactions: DataFrame, as_of: Column, top_k: int = 8) -> TrainedTables:
    """Both kinds of neighbours in one table, keyed by source, neighbour and algorithm."""
    return TrainedTables(
        neighbors=covisit.collaborative_neighbors(interactions, top_k).unionByName(
            content.content_neighbors(content.item_corpus(items), top_k)
        ),
        trending=trending.trending_items(interactions, as_of),
    )


def version_record(spark: SparkSession, as_of: datetime) -> DataFrame:
    stamp = F.lit(as_of).cast("timestamp_ntz")
    return spark.range(1).select(
        model_version_id(stamp).alias("version"), F.lit(DESCRIPTION).alias("description"), stamp.alias("created_at")
    )


def publish(tables: TrainedTables, path: str, as_of: datetime) -> str:
    """Write a full new set of tables, then the version row that makes it visible.

    Readers resolve the newest version row, so they see the old set or the new one and never a mix.
    A run that fails earlier leaves no version row.
    """
    spark = tables.neighbors.sparkSession
    record = version_record(spark, as_of)
    version = record.first()["version"]
    while exists(spark, f"{path}/model_version={version}"):  # versions have seconds; a set in use is never replaced
        as_of += timedelta(seconds=1)
        record = version_record(spark, as_of)
        version = record.first()["version"]
    for name, table in (("neighbors", tables.neighbors), ("trending", tables.trending)):
        table.withColumn("updated_at", F.current_timestamp()).write.mode("overwrite").parquet(
            f"{path}/model_version={version}/{name}"
        )
    record.write.mode("append").parquet(f"{path}/versions")
    return version


def versions(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(schema.MODEL_VERSIONS).parquet(f"{path}/versions")
    except AnalysisException:
        return spark.createDataFrame([], schema.MODEL_VERSIONS)


def read_published(spark: SparkSession, path: str) -> TrainedTables:
    """The newest complete set; empty tables before the first training."""
    version = latest_version(versions(spark, path)).first()["model_version"]
    if version == "untrained":
        return TrainedTables(
            spark.createDataFrame([], schema.NEIGHBORS), spark.createDataFrame([], schema.TRENDING)
        )
    root = f"{path}/model_version={version}"
    return TrainedTables(
        spark.read.schema(schema.NEIGHBORS).parquet(f"{root}/neighbors"),
        spark.read.schema(schema.TRENDING).parquet(f"{root}/trending"),
    )


def summary(tables: TrainedTables) -> DataFrame:
    """Rows per output of a training run."""
    edges = tables.neighbors.groupBy(F.concat("algorithm", F.lit("_edges")).alias("output")).agg(
        F.count("*").alias("rows")
    )
    return edges.unionByName(tables.trending.agg(F.count("*").alias("rows")).withColumn("output", F.lit("trending_rows")))


def load_if_empty(rows: DataFrame, path: str) -> None:
    """Seed a table: write the rows only where nothing is stored yet."""
    rows.write.mode("ignore").parquet(path)
