"""Continuous ingestion: archive, quarantine, de-duplicated facts and incremental features.

Three queries read the same messages, each with its own checkpoint:

* ``archive`` stores usable messages by hour, ``quarantine`` the unusable ones.
* ``facts`` keeps the first message per event id, forever, with the seen ids in a RocksDB state store,
  so a batch costs its own size and not the size of the history. Each batch writes its facts and, from
  these, a small summary per feature.

The ids are kept without end, which is what "forever" costs: about 60 bytes of state per id; a ``horizon`` bounds
it. Every batch writes to a folder named by its id and replaces it when it is run again, so a batch that is
repeated after a failure changes nothing. Feature summaries can be merged in any order (newest time, set
union, sums); a busy user or title is reduced inside each task before anything is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators import features
from marquee.schema import STORED_FACTS
from marquee.session import adaptive, materialize, remove, scratch
from marquee.sources.archive import write_archive
from marquee.sources.events import decode, quarantined, usable
from marquee.streaming import trending
from marquee.streaming.store import BatchStore

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RECENT_KEPT = 20
FEATURES = ("recent", "watched", "affinity", "popularity", "consumed", "panes")
COMPACT_EVERY = 60


@dataclass(frozen=True)
class Paths:
    """Folders below one output root."""

    root: str

    @property
    def archive(self) -> str:
        return f"{self.root}/archive"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def facts(self) -> str:
        return f"{self.root}/facts"

    def feature(self, name: str) -> str:
        return f"{self.root}/features/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def read_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages from text files, one JSON message per line."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def deduplicated(events: DataFrame, horizon: str | None = None) -> DataFrame:
    """First event per id: forever, or with a ``horizon`` only among events that close in event time."""
    if horizon:
        return events.withWatermark("event_ts", horizon).dropDuplicatesWithinWatermark(["event_id"])
    return events.dropDuplicates(["event_id"])


def batch_features(facts: DataFrame, items: DataFrame) -> dict[str, DataFrame]:
    """Mergeable summaries of one batch of facts; the summary per user and title is computed once."""
    summary = materialize(features.user_item_summary(facts, items), "summary")
    return {
        "recent": features.recent_items(features.last_seen(summary), RECENT_KEPT).drop("position"),
        "watched": features.watched_items(summary),
        "affinity": features.genre_affinity(summary, items),
        "popularity": features.regional_popularity(facts, items),
        "consumed": facts.groupBy("event_type").agg(F.count("*").alias("n")),
        "panes": trending.panes(facts),
    }


def merge_feature(name: str, parts: DataFrame) -> DataFrame:
    """Combine batch summaries of a feature.

    The newest 20 titles of each batch are enough for the newest 20 overall: the last event of a title
    lies in some batch, and whatever ranks before it there ranks before it overall.
    """
    if name == "recent":
        newest = parts.groupBy("user_id", "item_id").agg(F.max("last_ts").alias("last_ts"))
        return features.recent_items(newest, RECENT_KEPT)
    if name == "watched":
        return parts.select("user_id", "item_id").distinct()
    if name == "affinity":
        return parts.groupBy("user_id", "genre").agg(F.sum("affinity").cast("decimal(18,6)").alias("affinity"))
    if name == "popularity":
        return parts.groupBy("region", "item_id").agg(F.sum("popularity").cast("decimal(18,6)").alias("popularity"))
    if name == "consumed":
        return parts.groupBy("event_type").agg(F.sum("n").alias("n"))
    if name == "panes":
        return trending.merged_panes(parts)
    raise ValueError(f"unknown feature {name}")


def _archive_batch(paths: Paths):
    def write(batch: DataFrame, batch_id: int) -> None:
        write_archive(batch, paths.archive, batch_id)

    return write


def _write_batch(items: DataFrame, paths: Paths, compact_every: int | None = None):
    """Facts and feature summaries of a batch. Every ``compact_every`` batches they are merged right there, so no reader
    meets more than about twice as many folders.

    A stateful stream turns adaptive execution off in its session. That is for the plan of the stream, which is made
    before; what is written here uses it, so days are gathered in few files and small steps run few tasks."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            write_all(batch, batch_id)

    def write_all(batch: DataFrame, batch_id: int) -> None:
        spark, target = batch.sparkSession, f"{paths.facts}/batch_id={batch_id}"
        (
            batch.withColumns({"ingestion_ts": F.localtimestamp(), "event_date": F.to_date("event_ts")})
            .hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(target)
        )
        facts = spark.read.schema(STORED_FACTS).parquet(target)
        with scratch(spark, f"batch-{batch_id}"):
            for name, part in batch_features(facts, items).items():
                part.write.mode("overwrite").parquet(f"{paths.feature(name)}/batch_id={batch_id}")
        write_trending(spark, paths.root, batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_facts(spark, paths.root)
            for name in FEATURES:
                compact(spark, paths.root, name)

    return write


def ingest(
    spark: SparkSession,
    messages: DataFrame,
    items: DataFrame,
    root: str,
    trigger: dict | None = None,
    horizon: str | None = None,
    compact_every: int | None = COMPACT_EVERY,
) -> list[StreamingQuery]:
    """Start the ingestion of a streaming ``value`` column; results go below ``root``.

    Facts and features are compacted every ``compact_every`` batches, by the query that writes them; the archive with
    ``archive.compact_archive``, by whoever knows that an hour is over.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    paths = Paths(root.rstrip("/"))
    trigger = trigger or {"processingTime": "10 seconds"}
    decoded = decode(messages)
    events = usable(decoded)

    archive = (
        events.writeStream.queryName("archive").foreachBatch(_archive_batch(paths))
        .option("checkpointLocation", paths.checkpoint("archive")).trigger(**trigger).start()
    )
    quarantine = (
        quarantined(decoded)
        .writeStream.queryName("quarantine").format("parquet")
        .option("checkpointLocation", paths.checkpoint("quarantine")).trigger(**trigger).start(paths.quarantine)
    )
    facts = (
        deduplicated(events.drop("value"), horizon)
        .writeStream.queryName("facts").foreachBatch(_write_batch(items, paths, compact_every))
        .option("checkpointLocation", paths.checkpoint("facts")).trigger(**trigger).start()
    )
    return [archive, quarantine, facts]


def finish(queries: list[StreamingQuery]) -> None:
    """Wait for queries that run on ``availableNow``."""
    for query in queries:
        query.awaitTermination()


def batches_after(spark: SparkSession, folder: str, done: int | None) -> list[int]:
    """Ids of the batch folders that come after ``done``."""
    return BatchStore(folder).batches(spark, done)


def _bases(spark: SparkSession, folder: str) -> list[int]:
    return BatchStore(folder).bases(spark)


def fact_store(root: str) -> BatchStore:
    return BatchStore(Paths(root).facts, STORED_FACTS, cumulative=False)


def feature_store(root: str, name: str) -> BatchStore:
    return BatchStore(Paths(root).feature(name))


def read_facts(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """Stored facts with event time as the batch jobs expect it."""
    facts = fact_store(root).read(spark, before)
    return facts.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


def last_batch(spark: SparkSession, root: str) -> int | None:
    """Id of the newest batch of facts, None before the first."""
    return fact_store(root).last(spark)


def compact_facts(spark: SparkSession, root: str) -> int | None:
    """Move the batches since the last compaction into one set of files per day; earlier sets are not rewritten.

    Returns the last batch that is covered.
    """
    return fact_store(root).compact(spark, lambda rows: rows.hint("rebalance", "event_date"), "event_date")


def read_feature(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Current state of a feature: newest compaction merged with the batches after it."""
    merged = merge_feature(name, feature_store(root, name).read(spark))
    if "last_ts" in merged.columns:
        merged = merged.withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz"))
    return merged


def write_trending(spark: SparkSession, root: str, batch_id: int) -> None:
    """The best titles of every region after a batch, for readers that want them at once; the batch before stays."""
    sums = trending.window_sums(feature_store(root, "panes").read(spark), fact_store(root).read(spark))
    store = feature_store(root, "trending")
    store.write(trending.top_titles(sums), batch_id)
    for old in store.batches(spark):
        if old < batch_id - 1:
            remove(spark, store.path(old))


def read_trending(spark: SparkSession, root: str) -> DataFrame:
    """The best titles of every region in the hours before the newest event."""
    store = feature_store(root, "trending")
    return spark.read.parquet(store.path(store.last(spark)))


def compact(spark: SparkSession, root: str, name: str) -> int | None:
    """Merge the newest compaction of a feature and the batches after it into a new one.

    It is visible when it is complete. What the previous compaction covers is then removed.
    """
    return feature_store(root, name).compact(spark, lambda rows: merge_feature(name, rows))
