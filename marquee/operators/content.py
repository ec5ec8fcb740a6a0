"""TF-IDF cosine similarity between texts, best neighbours per text.

Exact, and no pair of texts ever becomes a row:

1. Copies (same bag of tokens) are folded into one vector that stands for its members.
2. Vectors are cut into blocks of bounded size, similar ones together (by topic where there are many, and common terms
   among their heaviest), and blocks into cells.
3. Each block finds the best matches among its own vectors, which gives every vector a lower bound: the score that a
   match elsewhere must reach.
4. An inverted index over cells holds, per term, the largest weight in the cell. The products of a vector's weights with
   them add up to an upper bound of its scores in the cell; so do the products of its heaviest terms plus the length of
   the lighter rest. A vector travels to a block only if it asks one of the block's cells, or
   lies in a cell that a vector of the block asks: where the upper bound reaches the lower one. Blocks that ask
   nothing of each other never meet. Where a sample of blocks asks for most meetings, all blocks meet and nothing is asked.
5. Blocks meet in squares: some blocks and some others in one task, so a vector travels once per square and not once
   per block. The dot products of two blocks are added up term by term in a small dense array in single precision, each
   pair of blocks raises the bounds of the next ones, pairs that may be among the best are added up in double precision, and at most ``top_k`` matches per vector leave the task.
6. Neighbours of a vector are unfolded to member texts, smallest ids first.

A term or a group of copies that covers much of the corpus makes no task larger: tasks are cut by
vectors, not by terms. Where the bounds prune little, the work of steps 4 and 5 grows with the square of the corpus; their
moved rows do not stay on disk: they go in rounds that move a few times the corpus each, and a round's shuffle files and
the matches it replaces are removed.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from marquee.functions.blocks import (
    ASKS, MATCHES, asked_by_blocks, matches_in_square, matches_within, topic_centers, with_topics,
)
from marquee.functions.text import corpus_text, tokens
from marquee.session import fresh_path, materialize, remove, shuffle_files_removed

# Vectors and postings per block: two blocks and the array of their dot products fit in a task.
BLOCK_VECTORS = 2048
BLOCK_POSTINGS = 2_000_000
MOST_TASKS = 20_000
#: Vectors per cell of the bound index, blocks that ask it in a task, and postings of the blocks asked there.
CELL_VECTORS = 64
HEAVY_TERMS = 8
ASKING_BLOCKS = 8
CHUNK_POSTINGS = 4_000_000
LEAST_CHUNKS = 4
#: Postings of a side of a square, sides at least where there are as many blocks, and postings that a round of squares
#: moves: a multiple of all postings, or the number that is not worth a second round.
SQUARE_POSTINGS = 3_000_000
LEAST_SIDES = 8
ROUND_SHARE = 4
ROUND_POSTINGS = 100_000_000
#: Blocks from which on vectors are placed by topic first and the index is tried on a sample of blocks before all ask it;
#: blocks and one in so many vectors of that sample, and the share of its meetings from which on all blocks meet.
MANY_BLOCKS = 16
SAMPLE_BLOCKS, SAMPLE_SHARE = 8, 16
MET_SHARE = 0.5
#: Topics, the vectors that they are taken from and their most common terms.
TOPICS, TOPIC_VECTORS, TOPIC_TERMS = 16, 2_000, 1_000


def active_items(items: DataFrame) -> DataFrame:
    return items.filter("is_active")


def item_corpus(items: DataFrame) -> DataFrame:
    return active_items(items).select("item_id", corpus_text().alias("text"))


def term_counts(corpus: DataFrame, stop_words: tuple[str, ...] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(item_id, term, tf); ``keep`` names further columns that are constant per item."""
    return (
        corpus.select("item_id", *keep, F.explode(tokens(F.col("text"), stop_words)).alias("term"))
        .groupBy("item_id", *keep, "term")
        .agg(F.count("*").alias("tf"))
    )


def document_frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def with_frequency(counts: DataFrame) -> DataFrame:
    """``counts`` with the ``df`` of their terms. Vocabularies grow with the corpus, so none is sent through the driver."""
    return counts.join(document_frequency(counts).hint("merge"), "term")


def idf(df: Column, n_docs: Column) -> Column:
    return F.ln((1.0 + n_docs) / (1.0 + df)) + 1.0


def tfidf(corpus: DataFrame, stop_words: tuple[str, ...] | None = None) -> DataFrame:
    """Unit-length TF-IDF weights (item_id, term, tf, df, weight)."""
    counts = term_counts(corpus, stop_words)
    n_docs = corpus.agg(F.count("*")).scalar()
    raw = F.col("tf") * idf(F.col("df"), n_docs)
    per_item = Window.partitionBy("item_id")
    return (
        with_frequency(counts)
        .withColumn("raw", raw)
        .withColumn("weight", F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(per_item)))
        .select("item_id", "term", "tf", "df", "weight")
    )


def _fold_copies(corpus: DataFrame, stop_words: tuple[str, ...] | None) -> tuple[DataFrame, DataFrame]:
    """Texts with their token bag and its digest, and one numbered row per distinct bag.

    The corpus is read and tokenised here only. Numbers sort like the smallest member id. Texts without tokens
    have a NULL digest and no vector.
    """
    bag = F.sort_array(tokens(F.col("text"), stop_words))
    digest = F.when(F.size("bag") > 0, F.sha2(F.concat_ws(" ", "bag"), 256))
    texts = materialize(corpus.select("item_id", bag.alias("bag")).withColumn("digest", digest), "content-texts")
    vectors = (
        texts.filter(F.col("digest").isNotNull())
        .groupBy("digest").agg(F.min("item_id").alias("first_id"), F.count("*").alias("copies"))
        .orderBy("first_id")
        .withColumn("v", F.monotonically_increasing_id())
    )
    return texts, materialize(vectors, "content-vectors")


def _vectors_with_weights(texts: DataFrame, vectors: DataFrame) -> DataFrame:
    """(v, copies, terms, weights, heads) of each distinct vector of length one, heaviest first. ``heads`` are its
    ``HEAVY_TERMS`` heaviest terms, the most common first, without those that most vectors hold; by them it is placed.

    A term of one vector alone adds to its length and to no product, so it is not among the terms; vectors that share no
    term have no matches and are left out.
    """
    chosen = vectors.select(F.col("first_id").alias("item_id"), "v", "copies")
    words = texts.select("item_id", "bag").join(chosen, "item_id").select("v", "copies", F.explode("bag").alias("term"))
    counts = materialize(words.groupBy("v", "copies", "term").agg(F.count("*").alias("tf")), "content-terms")
    n_docs = texts.agg(F.count("*")).scalar()
    frequency = counts.groupBy("term").agg(F.sum("copies").alias("df"), F.count("*").alias("vectors"))
    numbered = materialize(
        frequency.withColumn("t", F.monotonically_increasing_id()).withColumn("idf", idf(F.col("df"), n_docs)),
        "content-vocabulary",
    )
    split = F.filter(F.slice("heaviest", 1, HEAVY_TERMS), lambda one: one["vectors"] * 2 <= F.lit(vectors.count()))
    common = F.transform(split, lambda one: F.struct(one["vectors"].alias("n"), one["t"].alias("t")))
    heads = F.transform(F.sort_array(common, asc=False), lambda one: one["t"])
    raw = counts.join(numbered, "term").select("v", "copies", "t", "vectors", (F.col("tf") * F.col("idf")).alias("raw"))
    return (
        raw.groupBy("v", "copies").agg(
            F.sort_array(F.collect_list(F.when(F.col("vectors") > 1, F.struct("raw", "t", "vectors"))), asc=False).alias("heaviest"),
            F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"),
        )
        .filter(F.size("heaviest") > 0)
        .select(
            "v", "copies",
            F.transform("heaviest", lambda one: one["t"]).alias("terms"),
            F.transform("heaviest", lambda one: one["raw"] / F.col("norm")).alias("weights"),
            heads.alias("heads"),
        )
    )


def _cut_into_blocks(
    vectors: DataFrame, block_vectors: int, block_postings: int = BLOCK_POSTINGS
) -> tuple[DataFrame, int]:
    """Vectors with ``block`` and ``cell`` numbers. Blocks follow the heads, so likely neighbours share one.

    A vector fills a share of a block, by its postings or as one of ``block_vectors``; blocks are cut where the
    running sum of shares passes a whole number, so none holds more than its bounds and one vector. The sum is
    added up within ranges of the order first, then over the ranges.
    """
    if "heads" not in vectors.columns:
        vectors = vectors.withColumn("heads", F.slice("terms", 1, HEAVY_TERMS))
    order = [F.col("heads"), F.col("v")]
    share = F.greatest(F.lit(1.0 / block_vectors), F.size("terms") / F.lit(float(block_postings)))
    vectors = materialize(vectors.withColumn("share", share), "content-weights")
    total, count = vectors.agg(F.coalesce(F.sum("share"), F.lit(0.0)), F.count("*")).first()
    if total >= MANY_BLOCKS:
        vectors, order = _with_topics(vectors, count), [F.col("topic"), *order]
    ranged = materialize(
        vectors.repartitionByRange(max(1, math.ceil(4 * total)), *order).withColumn("range", F.spark_partition_id()),
        "content-ranges",
    )
    so_far = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        ranged.groupBy("range").agg(F.sum("share").alias("sum"))
        .select("range", F.coalesce(F.sum("sum").over(so_far), F.lit(0.0)).alias("before"))
    )
    inside = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("share").over(inside), F.lit(0.0))
    cells = max(1, math.ceil(block_vectors / CELL_VECTORS))
    cut = materialize(
        ranged.join(ranges, "range").withColumn("at", at).withColumn("block", F.floor("at").cast("int"))
        .withColumn("cell", F.floor((F.col("at") - F.col("block")) * cells).cast("int"))
        .drop("range", "share", "before", "at", "heads", "topic"),
        "content-blocks",
    )
    return cut, (cut.agg(F.max("block")).first()[0] or 0) + 1


def _with_topics(vectors: DataFrame, count: int) -> DataFrame:
    """Vectors with a ``topic``, so that blocks hold texts of one language or subject: such blocks share their common terms and
    have few products with others. Topics are found on a sample, by its most common terms; they place vectors, no more."""
    one_of = F.lit(-(-count // TOPIC_VECTORS))
    sample = vectors.filter(F.pmod(F.xxhash64("v"), one_of) == 0).select(
        "v", F.explode(F.arrays_zip("terms", "weights")).alias("p")
    ).select("v", F.col("p.terms").alias("t"), F.col("p.weights").alias("weight"))
    common = sample.groupBy("t").count().orderBy(F.desc("count"), "t").limit(TOPIC_TERMS).select("t")
    found = sample.join(common, "t").orderBy("v", "t").toArrow()
    v, t = (np.unique(found[name].to_numpy(), return_inverse=True) for name in ("v", "t"))
    if not len(v[0]):
        return vectors.withColumn("topic", F.lit(0))
    dense = np.zeros((len(v[0]), len(t[0])), np.float32)
    dense[v[1], t[1]] = found["weight"].to_numpy()
    schema = StructType([*vectors.schema.fields, StructField("topic", IntegerType())])
    return vectors.mapInArrow(with_topics(t[0], topic_centers(dense, TOPICS)), schema)


def _cell_index(vectors: DataFrame) -> DataFrame:
    """(block, cell, terms, tops): the largest weight of each term in each cell. Cells are stored together, so most of
    the maximum is taken before the shuffle."""
    posting = F.explode(F.arrays_zip("terms", "weights")).alias("p")
    tops = (
        vectors.select("block", "cell", posting).groupBy("block", "cell", F.col("p.terms").alias("t"))
        .agg(F.max("p.weights").alias("top"))
    )
    return tops.groupBy("block", "cell").agg(F.collect_list("t").alias("terms"), F.collect_list("top").alias("tops"))


def _rounds(moved: int, postings: int) -> int:
    """Rounds that move ``ROUND_SHARE`` times the corpus each, one if that is little."""
    return max(1, -(-moved // max(ROUND_SHARE * postings, ROUND_POSTINGS)))


def _places(groups: int) -> int:
    """Partitions for so many groups: some more, so that few of them share one."""
    return min(4 * groups, MOST_TASKS)


def _in_round(keys: tuple[Column, ...], rounds: int, number: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("round"), *keys), F.lit(rounds)) == number


def _asks(bounded: DataFrame, index: DataFrame, blocks: int, postings: int) -> DataFrame:
    """What each block asks of the cells of every other block: (block, v, cell, others), see ``blocks.asked_cells``.

    ``ASKING_BLOCKS`` blocks, or more if there are very many, meet in a task the index of as many blocks as hold
    ``CHUNK_POSTINGS`` postings, so a vector travels once per such chunk and a cell's maxima once per group of blocks.
    """
    wide = max(1, min(CHUNK_POSTINGS * blocks // max(postings, 1), blocks // LEAST_CHUNKS))
    asking = max(1, wide if blocks > ASKING_BLOCKS * wide else ASKING_BLOCKS)
    group = lambda width: F.floor(F.col("block") / width).cast("int")
    askers, chunks = (blocks - 1) // asking + 1, (blocks - 1) // wide + 1
    rounds = _rounds(postings * (askers + chunks), postings)
    tasks = _places(-(-askers * chunks // rounds))
    path = fresh_path(bounded.sparkSession, "content-asks")
    for number in range(rounds):
        each = lambda last, one: F.filter(
            F.sequence(F.lit(0), F.lit(last - 1)), lambda other: _in_round(one(other), rounds, number)
        )
        left = bounded.select(
            group(asking).alias("asker"), F.explode(each(chunks, lambda other: (group(asking), other))).alias("chunk"),
            "block", "v", "terms", "weights", "bound",
        )
        right = index.select(
            F.explode(each(askers, lambda other: (other, group(wide)))).alias("asker"), group(wide).alias("chunk"),
            "block", "cell", "terms", "tops",
        )
        left, right = (side.repartition(tasks, "asker", "chunk").groupBy("asker", "chunk") for side in (left, right))
        with shuffle_files_removed(bounded.sparkSession):
            left.cogroup(right).applyInPandas(asked_by_blocks, ASKS).write.mode("append").parquet(path)
    return bounded.sparkSession.read.schema(ASKS).parquet(path)


def _postings(vectors: DataFrame) -> int:
    return vectors.agg(F.sum(F.size("terms"))).first()[0] or 0


def _met(bounded: DataFrame, blocks: int, postings: int) -> DataFrame:
    """Vectors with ``partners``, the other blocks they have to meet; those that meet none are left out."""
    asks = _asks(bounded, materialize(_cell_index(bounded), "content-cells"), blocks, postings)
    gathered = F.flatten(F.collect_list("others"))
    asking = asks.filter("v IS NOT NULL").groupBy("v").agg(gathered.alias("asking"))
    asked = asks.filter("cell IS NOT NULL").groupBy("block", "cell").agg(F.array_distinct(gathered).alias("asked"))
    nobody = F.array().cast("array<int>")
    partners = F.array_union(F.coalesce("asking", nobody), F.coalesce("asked", nobody))
    return (
        bounded.join(asking, "v", "left").join(asked, ["block", "cell"], "left")
        .withColumn("partners", partners).filter(F.size("partners") > 0).drop("asking", "asked", "cell")
    )


def _shipped(bounded: DataFrame, blocks: int) -> DataFrame:
    """(vector, partner): every vector with the other blocks it has to meet."""
    return _met(bounded, blocks, _postings(bounded)).withColumn("partner", F.explode("partners")).drop("partners")


def _with_squares(met: DataFrame, width: int) -> DataFrame:
    """Vectors with ``squares``: (low, high, blocks), the sides of each square they travel to and the blocks they meet there."""
    side = lambda block: F.floor(block / width).cast("int")
    own = side(F.col("block"))
    squares = F.transform(
        F.array_distinct(F.transform("partners", side)),
        lambda other: F.struct(
            F.least(own, other).alias("low"), F.greatest(own, other).alias("high"),
            F.filter("partners", lambda block: side(block) == other).alias("blocks"),
        ),
    )
    return met.withColumn("squares", squares).drop("partners")


def _in_all_squares(bounded: DataFrame, blocks: int, width: int) -> DataFrame:
    """As ``_with_squares``, where every vector meets every other block."""
    own, last = F.floor(F.col("block") / width).cast("int"), (blocks - 1) // width
    squares = F.transform(
        F.sequence(F.lit(0), F.lit(last)),
        lambda other: F.struct(
            F.least(own, other).alias("low"), F.greatest(own, other).alias("high"),
            F.filter(
                F.sequence(other * width, F.least(other * width + width, F.lit(blocks)) - 1), lambda block: block != F.col("block")
            ).alias("blocks"),
        ),
    )
    return bounded.drop("cell").withColumn("squares", F.filter(squares, lambda one: F.size(one["blocks"]) > 0))


def _all_meet(bounded: DataFrame, blocks: int) -> bool:
    """Whether most vectors of some blocks ask most others of these: then the index would cost more than it saves. Pairs of
    blocks that need not meet only add matches that are not among the best."""
    if blocks < MANY_BLOCKS:
        return False
    some = bounded.filter(F.col("block") % -(-blocks // SAMPLE_BLOCKS) == 0)
    askers = some.filter(F.pmod(F.xxhash64("v"), F.lit(SAMPLE_SHARE)) == 0)
    together = F.floor(F.col("block") / blocks).cast("int").alias("together")
    index = materialize(_cell_index(some), "content-sample-cells")
    sides = (side.select("*", together).groupBy("together") for side in (askers, index))
    asks = next(sides).cogroup(next(sides)).applyInPandas(asked_by_blocks, ASKS)
    asked = asks.filter("v IS NOT NULL").agg(F.sum(F.size("others"))).first()[0] or 0
    n, of = askers.count(), some.select("block").distinct().count()
    return asked >= MET_SHARE * n * (of - 1)


def _first_matches(matches: DataFrame, top_k: int) -> DataFrame:
    best_first = Window.partitionBy("x").orderBy(F.col("score").desc(), "y")
    return matches.withColumn("n", F.row_number().over(best_first)).filter(F.col("n") <= top_k).select("x", "y", "score")


def _matches_across(bounded: DataFrame, within: DataFrame, blocks: int, top_k: int) -> DataFrame:
    """The ``top_k`` best of ``within`` and of the matches between blocks, of every vector."""
    spark, postings = bounded.sparkSession, _postings(bounded)
    width = max(1, min(SQUARE_POSTINGS * blocks // max(postings, 1), blocks // LEAST_SIDES))
    if _all_meet(bounded, blocks):
        placed = _in_all_squares(bounded, blocks, width)
    else:
        placed = materialize(_with_squares(_met(bounded, blocks, postings), width), "content-squares")
    moved = placed.agg(F.sum(F.size("terms") * F.size("squares"))).first()[0] or 0
    rounds, sides = _rounds(moved, postings), (blocks - 1) // width + 1
    tasks = _places(-(-sides * (sides + 1) // (2 * rounds)))
    best, last = within, None
    for number in range(rounds):
        here = F.filter("squares", lambda one: _in_round((one["low"], one["high"]), rounds, number))
        found = (
            placed.select("block", "v", "terms", "weights", "bound", F.inline(here))
            .repartition(tasks, "low", "high").groupBy("low", "high").applyInPandas(matches_in_square(top_k), MATCHES)
        )
        path = fresh_path(spark, "content-matches")
        with shuffle_files_removed(spark):
            _first_matches(best.unionByName(found), top_k).write.parquet(path)
        if last is not None:
            remove(spark, last)
        best, last = spark.read.schema(MATCHES).parquet(path), path
    return best


def _with_bounds(vectors: DataFrame, within: DataFrame, top_k: int) -> DataFrame:
    """Vectors with the score of the ``top_k``-th text found so far, 0 while there are fewer. Copies of a vector are texts
    of score 1 for each other, and a match gives as many texts as it has copies."""
    copies = vectors.select(F.col("v").alias("y"), "copies")
    own = vectors.select(F.col("v").alias("x"), F.lit(1.0).alias("score"), (F.col("copies") - 1).alias("copies"))
    texts = within.join(copies, "y").select("x", "score", "copies").unionByName(own)
    so_far = Window.partitionBy("x").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    known = (
        texts.withColumn("n", F.sum("copies").over(so_far)).filter(F.col("n") >= top_k)
        .groupBy(F.col("x").alias("v")).agg(F.max("score").alias("bound"))
    )
    return vectors.join(known, "v", "left").withColumn("bound", F.coalesce("bound", F.lit(0.0)))


def _similar_vectors(vectors: DataFrame, top_k: int, block_vectors: int) -> DataFrame:
    """(x, y, score): the ``top_k`` best y of every x with positive score."""
    vectors, blocks = _cut_into_blocks(vectors, block_vectors)
    placed = vectors.repartition(min(blocks, MOST_TASKS), "block")
    within = placed.groupBy("block").applyInPandas(matches_within(top_k), MATCHES)
    if blocks == 1:
        return within
    within = materialize(within, "content-within")
    bounded = materialize(_with_bounds(vectors, within, top_k), "content-bounded")
    return _matches_across(bounded, within, blocks, top_k)


def _first_members(texts: DataFrame, vectors: DataFrame, limit: int) -> DataFrame:
    """(v, members): the smallest member ids of each vector, at most ``limit``."""
    window = Window.partitionBy("digest").orderBy("item_id")
    return (
        texts.filter(F.col("digest").isNotNull())
        .withColumn("n", F.row_number().over(window)).filter(F.col("n") <= limit)
        .join(vectors.select("digest", "v"), "digest")
        .groupBy("v").agg(F.sort_array(F.collect_list("item_id")).alias("members"))
    )


def similar_texts(
    corpus: DataFrame,
    top_k: int = 8,
    stop_words: tuple[str, ...] | None = None,
    block_vectors: int = BLOCK_VECTORS,
) -> DataFrame:
    """(item_id, matches): per text its best other texts as a sorted array of (neighbor, score) with
    positive score, NULL or empty when there is none."""
    texts, vectors = _fold_copies(corpus, stop_words)
    weights = _vectors_with_weights(texts, vectors)

    best = _similar_vectors(weights, top_k, block_vectors)
    own = vectors.select(F.col("v").alias("x"), F.col("v").alias("y"), F.lit(1.0).alias("score"))
    members = _first_members(texts, vectors, top_k + 1)
    # At most top_k + 1 vectors of top_k + 1 members each meet here.
    unfolded = best.unionByName(own).join(members.withColumnRenamed("v", "y"), "y").select(
        F.col("x").alias("v"), "score", F.explode("members").alias("neighbor")
    )
    member_first = Window.partitionBy("v").orderBy(F.col("score").desc(), "neighbor")
    lists = (
        unfolded.withColumn("n", F.row_number().over(member_first)).filter(F.col("n") <= top_k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list(F.struct("n", "neighbor", "score"))).alias("found"))
        .join(vectors.select("v", "digest"), "v")
        .select("digest", "found")
    )
    others = F.filter("found", lambda one: one["neighbor"] != F.col("item_id"))
    matches = F.transform(
        F.slice(others, 1, top_k), lambda one: F.struct(one["neighbor"].alias("neighbor"), one["score"].alias("score"))
    )
    # The generator keeps the lists a step of their own, so they are cut once and not once per use.
    return texts.join(lists, "digest", "left").select("item_id", F.inline(F.array(F.struct(matches.alias("matches")))))


def _edges(matches: DataFrame) -> DataFrame:
    return matches.select(F.col("item_id").alias("source_item_id"), F.inline("matches")).select(
        "source_item_id", F.col("neighbor").alias("neighbor_item_id"), "score"
    )


def content_scores(corpus: DataFrame, top_k: int = 8, **options) -> DataFrame:
    """Best neighbours with positive similarity."""
    return _edges(similar_texts(corpus, top_k, **options))


def content_neighbors(corpus: DataFrame, top_k: int = 8, **options) -> DataFrame:
    """As ``content_scores``, filled up to ``top_k`` with the smallest other ids at score 0."""
    smallest = corpus.select("item_id").orderBy("item_id").limit(top_k + 1)
    spare = smallest.agg(F.sort_array(F.collect_list("item_id"))).scalar()
    matches = F.coalesce("matches", F.array().cast("array<struct<neighbor:string,score:double>>"))
    unused = F.filter(
        F.col("spare"),
        lambda one: (one != F.col("item_id")) & ~F.array_contains(F.col("matches.neighbor"), one),
    )
    filler = F.transform(unused, lambda one: F.struct(one.alias("neighbor"), F.lit(0.0).alias("score")))
    filled = (
        similar_texts(corpus, top_k, **options)
        .select("item_id", F.inline(F.array(F.struct(matches.alias("matches"), spare.alias("spare")))))
        .select("item_id", F.when(F.size("matches") < top_k, F.slice(F.concat("matches", filler), 1, top_k))
                .otherwise(F.col("matches")).alias("matches"))
    )
    return _edges(filled).withColumn("algorithm", F.lit("content"))
