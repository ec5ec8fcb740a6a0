"""Topic source and sink. The Spark Kafka connector has to be on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marquee.sources.events import encode


def read_topic(spark: SparkSession, servers: str, topic: str = "user-events", **options: str) -> DataFrame:
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **options,
    }
    return spark.readStream.format("kafka").options(**settings).load().select("value")


def write_topic(events: DataFrame, servers: str, checkpoint: str, topic: str = "user-events") -> StreamingQuery:
    settings = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return encode(events).writeStream.format("kafka").options(**settings).start()
