"""Catalog, users and interactions derived from a star schema of orders and web events.

Every table is read whole. Parts are the catalog, customers the audience, and the event table (or
the order lines) the interactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import spread


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _padded(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.lpad(F.col(column).cast("string"), 10, "0"))


def items(spark: SparkSession, root: str) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    return spread(table(spark, root, "part")).select(
        _padded("m", "p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.when(key % 2 == 0, "movie").otherwise("series").alias("item_type"),
        F.concat(F.split_part("p_name", F.lit(" "), F.lit(2)), F.lit(", "), F.lower("p_type")).alias("genres"),
        F.lit("").alias("actors"),
        F.col("p_brand").alias("director"),
        F.concat("p_name", F.lit(" in "), F.lower("p_type"), F.lit(" size "), size.cast("string")).alias("synopsis"),
        F.lit("en").alias("language"),
        (F.lit(2018) + size % 10).cast("int").alias("release_year"),
        F.when(size % 4 == 0, "G").when(size % 4 == 1, "PG").when(size % 4 == 2, "PG-13").otherwise("R")
        .alias("maturity_rating"),
        F.when(key % 5 == 0, "EUROPE,ASIA").when(key % 7 == 0, "AMERICA").otherwise("GLOBAL,AFRICA")
        .alias("available_regions"),
        (key % 17 != 0).alias("is_active"),
    )


def _with_region(spark: SparkSession, root: str, customers: DataFrame) -> DataFrame:
    return customers.join(table(spark, root, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        table(spark, root, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


def users(spark: SparkSession, root: str) -> DataFrame:
    grade = F.col("c_custkey") % 5
    return _with_region(spark, root, spread(table(spark, root, "customer"))).select(
        _padded("u", "c_custkey").alias("user_id"),
        F.col("r_name").alias("region"),
        F.lit("en").alias("preferred_language"),
        F.when(grade == 0, "G").when(grade == 1, "PG").when(grade == 2, "PG-13").when(grade == 3, "R")
        .otherwise("NR").alias("maturity_rating"),
    )


def interactions(spark: SparkSession, root: str) -> DataFrame:
    """Interactions from the event table. Keys below 5 are titles that left the catalog."""
    key = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    log = spread(table(spark, root, "events")).withColumnRenamed("user_id", "c_key")
    with_customer = log.join(table(spark, root, "customer"), F.col("c_key") == F.col("c_custkey"))
    return (
        _with_region(spark, root, with_customer)
        .select(
            F.col("event_id").cast("string").alias("event_id"),
            _padded("u", "c_key").alias("user_id"),
            F.concat(F.when(key.cast("int") < 5, "x").otherwise("m"), F.lpad(key, 10, "0")).alias("item_id"),
            F.when(kind == "error", "impression").when(kind == "click", "click")
            .when((kind == "view") & (F.col("event_id") % 2 == 0), "play_start")
            .when(kind == "view", "watch_progress").when(kind == "purchase", "complete")
            .otherwise("watchlist_add").alias("event_type"),
            F.floor(F.col("value") * 4).cast("int").alias("watch_seconds"),
            F.least(F.col("value").cast("decimal(12,2)") * F.lit(0.1).cast("decimal(2,1)"), F.lit(100).cast("decimal(14,3)"))
            .cast("double").alias("completion_pct"),
            F.col("r_name").alias("region"),
            F.when(F.col("event_id") % 3 == 0, "web").when(F.col("event_id") % 3 == 1, "mobile").otherwise("tv")
            .alias("device_type"),
            F.col("ts").alias("event_ts"),
        )
    )


def baskets(spark: SparkSession, root: str) -> DataFrame:
    """Who bought which part, as (user_id, item_id) over the whole order history."""
    return (
        spread(table(spark, root, "lineitem"))
        .join(table(spark, root, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(_padded("u", "o_custkey").alias("user_id"), _padded("m", "l_partkey").alias("item_id"))
    )


def documents(spark: SparkSession, root: str) -> DataFrame:
    return spread(table(spark, root, "documents")).select(_padded("d", "doc_id").alias("item_id"), "text")


def genre_priors(spark: SparkSession, root: str) -> DataFrame:
    """Genre taste per user, given by the market segment."""
    segment = F.col("c_mktsegment")

    def taste(*pairs):
        return F.create_map(*[F.lit(value) for pair in pairs for value in pair])

    tastes = (
        F.when(segment == "BUILDING", taste(("bolt", 3), ("plate", 2)))
        .when(segment == "MACHINERY", taste(("gear", 3), ("rod", 2)))
        .when(segment == "AUTOMOBILE", taste(("gear", 2), ("bolt", 1)))
        .when(segment == "HOUSEHOLD", taste(("plate", 3)))
        .when(segment == "FURNITURE", taste(("ring", 1)))
    )
    return table(spark, root, "customer").select(
        _padded("u", "c_custkey").alias("user_id"), F.explode(tastes).alias("genre", "prior")
    )
