"""Mixing sources to target weights: Efraimidis-Spirakis order within a source, whole epochs first.

A source that should give more words than it has is read in whole epochs; the rest of its target is a
weighted sample without replacement. For the sample every document draws an exponential key, -ln(u) divided by
its quality weight, and the documents with the smallest keys are taken until the words of the rest are reached.

Plan: DataFrame functions only. Document rows are narrow (no text). Prefix sums of a source are two-level: keys
fall into ``KEY_BUCKETS`` ranges by a monotone function, the sums of a source's ranges are added in order, and
inside one range rows are ordered. So the rows of a hot source are spread over as many groups as there are ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.text import text_digest, word_count
from marquee.session import materialize

CYCLE = (5, 2, 1)
MOST_EPOCHS = 3
KEY_BUCKETS = 4096
SEED = "mix-1"
DIGITS = 13  # hexadecimal digits of a digest that make the random number, 52 bits


def sized_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with ``size`` in words, ``quality``, a quarter for those that are labelled bad, else 1, and the ``digest``
    of the text, which tells documents without an id apart."""
    bad = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_label")).filter("_label = 0")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text_digest(F.col("text")).alias("digest"))
    return sized.join(bad, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "source", "size", F.when(F.col("_label") == 0, 0.25).otherwise(1.0).alias("quality"), "digest"
    )


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) to (source, source_no, source_size, share, target).

    Shares repeat ``cycle`` over the sources in code-point order, null last. Targets divide the sum of all
    sizes by share; none exceeds ``most`` times its source, and the excess goes to the others by share. With
    the sources ordered by limit per share, a source is at its limit exactly when the level that would hold
    without the sources before it exceeds its limit, which a running sum tells. The table has one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    total = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.orderBy(F.col("limit") / F.col("share"), "source_no")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum("limit").over(before), F.lit(0))
    used = F.coalesce(F.sum("share").over(before), F.lit(0))
    return (
        sizes.withColumn("source_no", F.row_number().over(by_name).cast("long"))
        .withColumn("share", F.element_at(F.array(*map(F.lit, cycle)), ((F.col("source_no") - 1) % len(cycle) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * most)
        .withColumns({"everything": F.sum("source_size").over(total), "shares": F.sum("share").over(total)})
        .withColumn("level", (F.col("everything") - spent).cast("double") / (F.col("shares") - used).cast("double"))
        .withColumn("full", F.col("limit").cast("double") <= F.col("level") * F.col("share"))
        .withColumn("water", F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("share"), "source_no", "level"))).over(total)["level"])
        .select(
            "source", "source_no", "source_size", "share",
            F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("water") * F.col("share")).alias("target"),
        )
    )


def _uniform(key: Column, seed: str, otherwise: Column) -> Column:
    """A number in (0, 1] that depends on the document and the seed alone; ``otherwise`` stands for a null key."""
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), otherwise)))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 1.0) / (2.0 ** (4 * DIGITS) + 1.0)


def mix(
    docs: DataFrame, key: str = "doc_id", cycle: tuple[int, ...] = CYCLE, most: int = MOST_EPOCHS, seed: str = SEED,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Per document of (key, source, size, quality): the words the mix takes of it.

    Returns key, source, size, source_size, target, epochs and taken. A document is read ``epochs`` times whole,
    as often as the target holds the source, and once more if the sample of the rest takes it: in key order, as
    long as half of the document lies within the rest. So a source misses its target by at most half of one
    document. Reruns agree.

    Null sources form one source, ordered last. A null ``quality`` counts as 1, one that is not positive as the
    smallest weight. Null sizes are 0; documents without words are never taken. Repeated keys draw the same
    number; ties go by size. A document without a key draws by its ``digest``, if there is such a column, so documents
    without keys spread over all ranges. Columns named in ``carried`` are returned as well. No rows in give no rows out.
    """
    digest = F.hex(F.col("digest").cast("binary")) if "digest" in docs.columns else F.lit("null")
    quality = F.greatest(F.coalesce(F.col("quality").cast("double"), F.lit(1.0)), F.lit(1e-6))
    rows = materialize(
        docs.select(
            F.col(key).alias("key"), "source", F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("size"),
            (-F.ln(_uniform(F.col(key), seed, F.coalesce(digest, F.lit("null")))) / quality).alias("draw"),
            *[F.col(name).alias(f"carried_{i}") for i, name in enumerate(carried)],
        ), "mix-sizes",
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(totals, cycle, most), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    # Only the shares are joined to documents; Spark broadcasts them when they are small and splits a hot source
    # when they are not.
    named = rows.withColumnRenamed("source", "own").join(targets, F.col("own").eqNullSafe(F.col("source"))).drop("own")
    placed = named.withColumn("epochs", F.least(whole, F.lit(most))).withColumn(
        "bucket", F.floor((1.0 - F.exp(-F.col("draw"))) * KEY_BUCKETS).cast("int")
    )
    in_order = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        placed.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
        .select("source_no", "bucket", F.coalesce(F.sum("words").over(in_order), F.lit(0)).alias("before"))
    )
    inside = (
        Window.partitionBy("source_no", "bucket").orderBy("draw", "key", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rest = F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double")
    reached = (F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).cast("double") + F.col("size") / 2.0
    sampled = (F.col("epochs") < most) & (F.col("size") > 0) & (reached <= rest)
    return (
        placed.join(ranges, ["source_no", "bucket"])
        .withColumn("taken", F.col("size") * (F.col("epochs") + sampled.cast("long")))
        .select(
            F.col("key").alias(key), "source", "size", "source_size", "target", "epochs", "taken",
            *[F.col(f"carried_{i}").alias(name) for i, name in enumerate(carried)],
        )
    )


def repeated(docs: DataFrame, mixed: DataFrame, key: str = "doc_id", digest: Column | None = None) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, the columns of ``docs`` unchanged.

    Documents are found again by key and source, and with ``digest``, a column over ``docs``, by that of the carried
    column ``digest`` too. Keys may be null or repeat. Of n rows that agree in all of these the mix takes some number of
    copies in all; each gives an equal share of them, and those with the smaller hashes one more of what is left.
    """
    names = [key, "source", *(["digest"] if digest is not None else [])]
    groups = mixed.groupBy(*[F.col(name).alias(f"_k{i}") for i, name in enumerate(names)]).agg(
        F.count("*").alias("_rows"), F.sum(F.when(F.col("taken") > 0, F.expr("taken div size")).otherwise(0)).alias("_copies")
    ).filter("_copies > 0")
    row = F.struct(*[docs[c] for c in docs.columns])
    marks = [docs[key], docs["source"], *([digest] if digest is not None else [])]
    rows = docs.select(row.alias("_row"), *[mark.alias(f"_m{i}") for i, mark in enumerate(marks)])
    same = F.lit(True)
    for i in range(len(marks)):
        same = same & F.col(f"_m{i}").eqNullSafe(F.col(f"_k{i}"))
    found = rows.join(groups, same)
    share = F.expr("cast(_copies div _rows as int)")
    order = Window.partitionBy(*[f"_k{i}" for i in range(len(marks))]).orderBy(F.xxhash64("_row"))
    even = found.filter("_copies % _rows = 0").select("_row", share.alias("_times"))
    uneven = found.filter("_copies % _rows <> 0").withColumn("_n", F.row_number().over(order)).select(
        "_row", (share + F.expr("int(_n <= _copies % _rows)")).alias("_times")
    )
    each = even.unionByName(uneven).filter("_times > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return each.select("_row.*")
