"""Raw event archive, partitioned by the hour of the event, and its replay."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import children, remove

HOUR_PARTS = ("year", "month", "day", "hour")
ARCHIVE_SCHEMA = T.StructType([
    T.StructField(name, T.StringType()) for name in ("event_id", "user_id", "value", *HOUR_PARTS)
])


def with_hour_parts(events: DataFrame) -> DataFrame:
    formats = dict(zip(HOUR_PARTS, ("yyyy", "MM", "dd", "HH"), strict=True))
    return events.withColumns({name: F.date_format("event_ts", fmt) for name, fmt in formats.items()})


def write_archive(events: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Store the original messages (``value``). Hours are rebalanced, so a busy hour is split over
    several files and a quiet one is a single file.

    With a ``batch_id`` the batch gets a folder of its own within each hour, which it replaces when it is
    written again.
    """
    rows = with_hour_parts(events).select(*ARCHIVE_SCHEMA.fieldNames())
    if batch_id is None:
        rows.hint("rebalance", *HOUR_PARTS).write.mode("append").partitionBy(*HOUR_PARTS).json(path)
        return
    (
        rows.withColumn("batch_id", F.lit(batch_id)).hint("rebalance", *HOUR_PARTS)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*HOUR_PARTS, "batch_id").json(path)
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ARCHIVE_SCHEMA).json(path).select(*ARCHIVE_SCHEMA.fieldNames())


def hour_folders(spark: SparkSession, path: str, start: datetime, end: datetime) -> list[str]:
    """Folders of the hours from ``start`` up to, not including, ``end``. Years, months and days outside are
    not listed."""
    low = [start.strftime(f) for f in ("%Y", "%m", "%d", "%H")]
    high = [end.strftime(f) for f in ("%Y", "%m", "%d", "%H")]
    found = [([], path)]
    for depth, name in enumerate(HOUR_PARTS, 1):
        found = [
            ([*values, value], f"{folder}/{name}={value}")
            for values, folder in found for value in children(spark, folder, name)
            if low[:depth] <= [*values, value] <= high[:depth]
        ]
    return [folder for values, folder in found if values < high]


def replay(spark: SparkSession, path: str, start: datetime, end: datetime) -> DataFrame:
    """Archived messages of the hours from ``start`` up to, not including, ``end``; other folders are neither
    listed nor read.

    A message that was archived more than once comes back once.
    """
    folders = hour_folders(spark, path, start, end)
    if not folders:
        return spark.createDataFrame([], ARCHIVE_SCHEMA)
    rows = spark.read.schema(ARCHIVE_SCHEMA).option("basePath", path).json(folders)
    return rows.select(*ARCHIVE_SCHEMA.fieldNames()).dropDuplicates(["event_id", "user_id", *HOUR_PARTS])


def compact_archive(spark: SparkSession, path: str, start: datetime, end: datetime) -> int:
    """Merge the batch folders of the hours from ``start`` up to ``end``, which must be over, to one folder per hour.

    The merged folder is written before the others are removed, and a replay gives a message once, so a job that fails in
    between loses and doubles nothing. Copies of a message are folded. Returns the number of folders removed.
    """
    crowded = {}
    for hour in hour_folders(spark, path, start, end):
        batches = children(spark, hour, "batch_id")
        if len(batches) > 1:
            crowded[hour] = batches
    if not crowded:
        return 0
    folders = [f"{hour}/batch_id={batch}" for hour, batches in crowded.items() for batch in batches]
    rows = spark.read.schema(ARCHIVE_SCHEMA).option("basePath", path).json(folders)
    merged = f"merged-{uuid.uuid4().hex}"
    (
        rows.select(*ARCHIVE_SCHEMA.fieldNames()).dropDuplicates(["event_id", "user_id", *HOUR_PARTS])
        .withColumn("batch_id", F.lit(merged)).hint("rebalance", *HOUR_PARTS)
        .write.mode("append").partitionBy(*HOUR_PARTS, "batch_id").json(path)
    )
    for folder in folders:
        remove(spark, folder)
    return len(folders)
