"""Periodic retraining while facts arrive."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.plans.train import publish, train
from marquee.session import children, scratch
from marquee.streaming.ingest import last_batch, read_facts

logger = logging.getLogger(__name__)


def _utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def train_if_due(
    spark: SparkSession, items: Callable[[], DataFrame], root: str, model_path: str,
    clock: Callable[[], datetime] = _utc_now,
) -> str | None:
    """Train on all facts and publish if facts came in since the last run that succeeded; the new version or None.

    What a run covers is marked after it was published, so a run that fails is due again. Its intermediate tables
    are removed either way.
    """
    newest = last_batch(spark, root)
    covered = max((int(value) for value in children(spark, f"{model_path}/trained", "upto")), default=-1)
    if newest is None or newest <= covered:
        return None
    now = clock()
    with scratch(spark, "training"):
        version = publish(train(items(), read_facts(spark, root), F.lit(now).cast("timestamp_ntz")), model_path, now)
    spark.range(1).write.mode("overwrite").parquet(f"{model_path}/trained/upto={newest}")
    return version


def retrain(
    spark: SparkSession,
    items: Callable[[], DataFrame],
    root: str,
    model_path: str,
    trigger: dict | None = None,
    clock: Callable[[], datetime] = _utc_now,
) -> StreamingQuery:
    """Train once per interval, if it is due. A failed run is logged and tried again at the next tick, with or
    without new facts; readers keep the last complete set. The ticks come from the rate source."""

    def run(_: DataFrame, tick: int) -> None:
        try:
            version = train_if_due(spark, items, root, model_path, clock)
            if version:
                logger.info("published %s", version)
        except Exception:
            logger.exception("training at tick %s failed", tick)

    return (
        spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        .writeStream.queryName("retrain").foreachBatch(run)
        .option("checkpointLocation", f"{model_path}/checkpoints/retrain")
        .trigger(**(trigger or {"processingTime": "60 seconds"})).start()
    )
