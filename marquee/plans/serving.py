"""A stored layout for single requests: a request reads a few row groups instead of whole tables.

User tables are cut into buckets by user and title tables by title. Within a bucket rows are sorted by that key, row groups
are small, and a Parquet Bloom filter on the key tells in which of them it can be. A request names its keys as literals, so
the bucket prunes folders, and statistics and filters prune row groups.

A request goes in three steps of bounded size: the user's rows (at most 20 recent titles), the neighbour lists of those
and the region's trending titles, and the facts of what they name, at most 180 titles. They come to the driver as the
small tables that ``recommend`` ranks; of the watched titles only those among them are fetched. All users at once are
recommended from the whole tables by ``recommend`` as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.candidates import RECENT_FOR_RANKING
from marquee.plans.recommend import ServingTables, recommend
from marquee.session import children

BUCKETS = 64
ROW_GROUP_BYTES = 1 << 20
PAGE_BYTES = 64 << 10
#: Tables with the key that places their rows.
KEYS = {
    "users": "user_id", "recent": "user_id", "watched": "user_id", "affinity": "user_id",
    "neighbors": "source_item_id", "items": "item_id", "trending": "region",
}


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_layout(tables: ServingTables, path: str, buckets: int = BUCKETS) -> None:
    """Write the tables for ``Requests`` below a new path; ``buckets`` should leave some 100 MB to a bucket of the
    largest table."""
    for name, key in KEYS.items():
        placed = getattr(tables, name).withColumn("bucket", _bucket(F.col(key), buckets))
        (
            placed.repartition(buckets, "bucket").sortWithinPartitions("bucket", key)
            .write.partitionBy("bucket")
            .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
            .option(f"parquet.bloom.filter.enabled#{key}", "true")
            .parquet(f"{path}/buckets={buckets}/{name}")
        )


class Requests:
    """Recommendations of one user at a time from a written layout. Schemas are read once."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        (self.buckets,) = map(int, children(spark, path, "buckets"))
        self.spark, self.root = spark, f"{path}/buckets={self.buckets}"
        self.tables = {name: spark.read.parquet(f"{self.root}/{name}") for name in KEYS}

    def rows(self, name: str, keys: list[str]) -> DataFrame:
        """The rows of some keys. The buckets are constants by the time the files are chosen."""
        key = KEYS[name]
        buckets = F.col("bucket").isin(*[_bucket(F.lit(k), self.buckets) for k in keys]) if keys else F.lit(False)
        return self.tables[name].filter(buckets & F.col(key).isin(*keys)).drop("bucket")

    def _local(self, rows: DataFrame) -> DataFrame:
        """Fetched rows, of a number that a request bounds, as a small table."""
        return self.spark.createDataFrame(rows.collect(), rows.schema)

    def tables_of(self, user_id: str) -> ServingTables:
        """What ``recommend`` needs for one user, as small tables."""
        users, recent, affinity = (self._local(self.rows(name, [user_id])) for name in ("users", "recent", "affinity"))
        regions = [r["region"] for r in users.collect() if r["region"] is not None]
        seen = [r["item_id"] for r in recent.collect() if r["position"] <= RECENT_FOR_RANKING]
        neighbors, trending = self._local(self.rows("neighbors", seen)), self._local(self.rows("trending", regions))
        named = {*seen, *(r["neighbor_item_id"] for r in neighbors.collect()), *(r["item_id"] for r in trending.collect())}
        items = self._local(self.rows("items", sorted(named)))
        watched = self._local(self.rows("watched", [user_id]).filter(F.col("item_id").isin(*sorted(named))) if named else
                              self.rows("watched", []))
        return ServingTables(users, items, recent, watched, affinity, neighbors, trending)

    def recommend(self, user_id: str, limit: int = 10, **options) -> DataFrame:
        """As ``recommend`` over the whole tables gives it for this user; no rows for an unknown one."""
        return recommend(self.tables_of(user_id), limit, **options)
