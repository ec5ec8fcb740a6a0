"""Co-visitation as a maintained view: pair counts grow by what new visits add, and only touched titles are ranked again.

A batch of events changes little, so nothing is recomputed from the history:

* New visits are those not stored yet; only the visits of the batch's users are looked up.
* Each new visit meets the old and the new visits of its user. The pairs found are counted and added to the stored
  counts as a delta; counts are sums, so deltas merge in any order and a compaction folds them.
* A title's list can change if one of its pairs got a new count or one of its partners new users. These titles are
  ranked from the stored counts; all others keep their edges.

The visits of a user with very many titles are split into parts of ``PER_SPLIT`` that meet the new ones in different
tasks. The counts are complete: every pair of titles with a common user is stored, in both directions, sorted by title.

Below ``root``: ``visits``, ``pairs`` and ``support`` by batch, and ``edges`` as a whole per batch, which marks the batch
as applied. A batch that failed half-way is run again from what was stored before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.operators.covisit import item_support
from marquee.session import children, exists, materialize, remove, scratch
from marquee.streaming.store import BatchStore

PER_SPLIT = 500
COMPACT_EVERY = 20
EDGES = (
    "source_item_id string, neighbor_item_id string, shared_users bigint, source_users bigint, neighbor_users bigint, score double"
)


@dataclass(frozen=True)
class View:
    root: str

    def _store(self, name: str, schema: str, cumulative: bool = True) -> BatchStore:
        return BatchStore(f"{self.root}/{name}", schema, cumulative)

    @property
    def visits(self) -> BatchStore:
        return self._store("visits", "user_id string, item_id string", cumulative=False)

    @property
    def pairs(self) -> BatchStore:
        return self._store("pairs", "item_id string, other_id string, shared bigint")

    @property
    def support(self) -> BatchStore:
        return self._store("support", "item_id string, users bigint")

    def applied(self, spark: SparkSession) -> int | None:
        """The last batch that is in the view."""
        done = [int(i) for i in children(spark, f"{self.root}/edges", "upto") if exists(spark, f"{self.root}/edges/upto={i}/_SUCCESS")]
        return max(done, default=None)

    def edges(self, spark: SparkSession) -> DataFrame:
        upto = self.applied(spark)
        return spark.createDataFrame([], EDGES) if upto is None else spark.read.schema(EDGES).parquet(f"{self.root}/edges/upto={upto}")


def _merged_pairs(rows: DataFrame) -> DataFrame:
    return rows.groupBy("item_id", "other_id").agg(F.sum("shared").alias("shared"))


def _merged_support(rows: DataFrame) -> DataFrame:
    return rows.groupBy("item_id").agg(F.sum("users").alias("users"))


def added_pairs(fresh: DataFrame, known: DataFrame, per_split: int = PER_SPLIT) -> DataFrame:
    """(item_id, other_id, shared): what the ``fresh`` visits add to the pair counts, in both directions.

    ``known`` are the earlier visits of their users. Neither side repeats a visit, and they have none in common.
    """
    partners = known.withColumn("is_fresh", F.lit(False)).unionByName(fresh.withColumn("is_fresh", F.lit(True)))
    parts = partners.groupBy("user_id").agg(F.ceil(F.count("*") / F.lit(per_split)).cast("int").alias("parts"))
    left = fresh.join(parts, "user_id").select(
        "user_id", F.col("item_id").alias("a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    right = partners.join(parts, "user_id").select(
        "user_id", F.col("item_id").alias("b"), "is_fresh", F.pmod(F.xxhash64("item_id"), "parts").cast("int").alias("part")
    )
    met = left.join(right, ["user_id", "part"]).filter("a <> b AND (NOT is_fresh OR a < b)")
    counted = met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("shared"))
    both = F.array(F.struct(F.col("a").alias("item_id"), F.col("b").alias("other_id")), F.struct(F.col("b").alias("item_id"), F.col("a").alias("other_id")))
    return counted.select(F.inline(both), "shared")


def pair_counts(visits: DataFrame, per_split: int = PER_SPLIT) -> DataFrame:
    """All pairs of titles with a common user, each once: (item_id, other_id, shared, users, other_users, score).

    Their number grows with the square of a user's titles; for neighbour lists alone ``covisit.covisit_edges`` needs no
    such table.
    """
    visits = materialize(visits, "pair-visits")
    nothing = visits.limit(0)
    support = item_support(visits)
    other = support.select(F.col("item_id").alias("other_id"), F.col("users").alias("other_users"))
    counts = added_pairs(visits, nothing, per_split).filter("item_id < other_id").join(support, "item_id").join(other, "other_id")
    score = F.round(F.col("shared") / F.sqrt(F.col("users") * F.col("other_users")), 6)
    return counts.select("item_id", "other_id", "shared", "users", "other_users", score.alias("score"))


def ranked(pairs: DataFrame, support: DataFrame, top_k: int = 8) -> DataFrame:
    """The best neighbours of each title, ordered as by ``covisit.covisit_edges``."""
    own = support.select("item_id", F.col("users").alias("source_users"))
    other = support.select(F.col("item_id").alias("other_id"), F.col("users").alias("neighbor_users"))
    order = Window.partitionBy("item_id").orderBy((F.col("shared") * F.col("shared") / F.col("neighbor_users")).desc(), "other_id")
    best = pairs.join(other, "other_id").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= top_k)
    return best.join(own, "item_id").select(
        F.col("item_id").alias("source_item_id"), F.col("other_id").alias("neighbor_item_id"), F.col("shared").alias("shared_users"),
        "source_users", "neighbor_users", F.round(F.col("shared") / F.sqrt(F.col("source_users") * F.col("neighbor_users")), 6).alias("score"),
    )


def apply_batch(view: View, visits: DataFrame, batch_id: int, top_k: int = 8, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Add the visits (user_id, item_id) of a batch, and return the edges after it. Repeated and known visits add nothing.

    Batches come in order; one that is already in the view changes nothing.
    """
    spark = visits.sparkSession
    done = view.applied(spark)
    if done is not None and batch_id <= done:
        return view.edges(spark)
    before = view.edges(spark)
    with scratch(spark, f"view-{batch_id}"):
        incoming = materialize(visits.select("user_id", "item_id").distinct(), "incoming")
        known = materialize(
            view.visits.read(spark, batch_id).join(incoming.select("user_id").distinct(), "user_id", "left_semi"), "known"
        )
        fresh = view.visits.write(incoming.join(known, ["user_id", "item_id"], "left_anti"), batch_id)
        delta = added_pairs(fresh, known).repartitionByRange("item_id").sortWithinPartitions("item_id", "other_id")
        view.pairs.write(delta, batch_id)
        view.support.write(item_support(fresh), batch_id)
        pairs, support = view.pairs.read(spark, batch_id + 1), _merged_support(view.support.read(spark, batch_id + 1))
        changed = fresh.select("item_id").distinct()
        partners = pairs.join(changed.withColumnRenamed("item_id", "other_id"), "other_id", "left_semi").select("item_id")
        touched = materialize(partners.unionByName(changed).distinct(), "touched")
        again = ranked(_merged_pairs(pairs.join(touched, "item_id", "left_semi")), support, top_k)
        kept = before.join(touched.withColumnRenamed("item_id", "source_item_id"), "source_item_id", "left_anti")
        again.unionByName(kept.select(*again.columns)).write.mode("overwrite").parquet(f"{view.root}/edges/upto={batch_id}")
    for old in children(spark, f"{view.root}/edges", "upto"):
        if done is not None and int(old) < done:  # the set before this one stays for running readers
            remove(spark, f"{view.root}/edges/upto={old}")
    if (batch_id + 1) % compact_every == 0:
        compact(view, spark)
    return view.edges(spark)


def compact(view: View, spark: SparkSession) -> None:
    """Fold the deltas of all applied batches."""
    upto = view.applied(spark)
    view.visits.compact(spark, upto=upto)
    view.support.compact(spark, _merged_support, upto=upto)
    view.pairs.compact(
        spark, lambda rows: _merged_pairs(rows).repartitionByRange("item_id").sortWithinPartitions("item_id", "other_id"), upto=upto
    )
