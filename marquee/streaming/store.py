"""Tables that grow by batches: one folder per batch, merged now and then.

A batch writes ``batch_id=<n>`` and replaces it when it is run again. A compaction writes ``<folder>-compacted/upto=<n>``,
which is visible when it is complete; readers take compactions and the batches after them by path, in one read. What a
compaction covers is removed by the next one, so readers that started before it can finish.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marquee.session import children, exists, remove


@dataclass(frozen=True)
class BatchStore:
    """``cumulative``: a compaction holds everything before it as well; else it adds to the earlier ones."""

    folder: str
    schema: T.StructType | str | None = None
    cumulative: bool = True

    def path(self, batch_id: int) -> str:
        return f"{self.folder}/batch_id={batch_id}"

    def _compacted(self, upto: int) -> str:
        return f"{self.folder}-compacted/upto={upto}"

    def write(self, rows: DataFrame, batch_id: int, *partitions: str) -> DataFrame:
        """Write a batch and read it back."""
        rows.write.mode("overwrite").partitionBy(*partitions).parquet(self.path(batch_id))
        return self._read(rows.sparkSession, [self.path(batch_id)])

    def batches(self, spark: SparkSession, after: int | None = None) -> list[int]:
        ids = sorted(int(value) for value in children(spark, self.folder, "batch_id"))
        return [i for i in ids if after is None or i > after]

    def bases(self, spark: SparkSession) -> list[int]:
        """Compactions that were written completely, oldest first."""
        found = sorted(int(value) for value in children(spark, f"{self.folder}-compacted", "upto"))
        return [i for i in found if exists(spark, f"{self._compacted(i)}/_SUCCESS")]

    def last(self, spark: SparkSession) -> int | None:
        return max([*self.bases(spark), *self.batches(spark)], default=None)

    def _read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        """One scan of the batches and one of the compactions, whatever their number."""
        reader = spark.read.schema(self.schema) if self.schema else spark.read
        parts = []
        for base in (self.folder, f"{self.folder}-compacted"):
            inside = [path for path in paths if path.startswith(f"{base}/")]
            if inside:
                parts.append(reader.option("basePath", base).parquet(*inside).drop("batch_id", "upto"))
        return functools.reduce(DataFrame.unionByName, parts)

    def paths(self, spark: SparkSession, before: int | None = None) -> list[str]:
        """The folders that make up the table, or what it was ``before`` a batch."""
        bases = [i for i in self.bases(spark) if before is None or i < before]
        fresh = [i for i in self.batches(spark, bases[-1] if bases else None) if before is None or i < before]
        used = bases[-1:] if self.cumulative else bases
        return [self._compacted(i) for i in used] + [self.path(i) for i in fresh]

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All rows; without any, an empty table if the schema is known."""
        paths = self.paths(spark, before)
        if paths:
            return self._read(spark, paths)
        if self.schema is None:
            raise ValueError(f"nothing was written below {self.folder}")
        return spark.createDataFrame([], self.schema)

    def compact(
        self, spark: SparkSession, merge: Callable[[DataFrame], DataFrame] = lambda rows: rows, *partitions: str,
        upto: int | None = None,
    ) -> int | None:
        """Merge the batches since the last compaction, at most ``upto``; returns the last batch that is covered."""
        bases = self.bases(spark)
        done = bases[-1] if bases else None
        fresh = [i for i in self.batches(spark, done) if upto is None or i <= upto]
        if not fresh:
            return done
        used = [self._compacted(i) for i in bases[-1:]] if self.cumulative else []
        parts = self._read(spark, used + [self.path(i) for i in fresh])
        merge(parts).select(*parts.columns).write.mode("overwrite").partitionBy(*partitions).parquet(self._compacted(fresh[-1]))
        for i in self.batches(spark):
            if done is not None and i <= done:
                remove(spark, self.path(i))
        for i in bases[:-1] if self.cumulative else []:
            remove(spark, self._compacted(i))
        return fresh[-1]
