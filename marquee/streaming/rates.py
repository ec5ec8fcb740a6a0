"""Event counts per minute as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def count_per_minute(
    events: DataFrame, root: str, trigger: dict | None = None, lateness: str = "24 hours"
) -> StreamingQuery:
    """Running counts per minute and event type. A changed window is written again with its full count.

    The watermark only bounds the state: a window is forgotten once it is ``lateness`` old.
    """
    counts = (
        events.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 minute")["start"].alias("window_start"), "event_type")
        .agg(F.count("*").alias("n"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/counts/batch_id={batch_id}")

    return (
        counts.writeStream.queryName("counts").outputMode("update").foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoints/counts")
        .trigger(**(trigger or {"processingTime": "1 minute"})).start()
    )


def read_counts(spark: SparkSession, root: str) -> DataFrame:
    """Last written count of every window."""
    return (
        spark.read.parquet(f"{root}/counts")
        .groupBy("window_start", "event_type").agg(F.max_by("n", "batch_id").alias("n"))
        .withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    )
