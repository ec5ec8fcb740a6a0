"""Item-item co-visitation: cosine of the user sets of two titles, best neighbours per title.

No pair of titles is moved between tasks. A title's row carries the whole list of a user who visited it to the task of
the title, which counts there how often each other title comes with it. Titles are numbered by support, then id; among
partners that share equally many users with a title the smaller number ranks first, so ``top_k`` per such count are
enough, and only these leave the task. Titles of very many users are counted in parts, which are added up.

Work per user grows with the square of the number of distinct titles, so users are split by size:

* Users up to ``pair_limit`` titles travel as whole lists.
* Larger users never do. Titles that the same large users touched form one class. What large users add to a pair
  depends only on the two classes, and among titles of one class that a source shares no small user with, the least
  visited rank first. The best ``top_k + 1`` titles of a class are therefore enough, and the result is exact. Lists of a
  large user's classes travel to the tasks of the titles, which count the overlaps of classes; these do not leave the
  task either, but for the first ``top_k + 1`` classes of each count.

With large users, titles are counted in rounds that move ``ROUND_PAIRS`` titles and classes each, whose shuffle files are
removed after each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.partners import CLASS_PARTNERS, PARTNERS, first_partners, first_with_classes
from marquee.functions.weights import is_engagement
from marquee.session import fresh_path, materialize, remove, shuffle_files_removed

PAIR_LIMIT = 500
#: Pairs that a task counts, titles of a large user per list, and users of a title that one task counts.
TASK_PAIRS = 4_000_000
MOST_TASKS = 20_000
LIST_TITLES = 2_000
HOT_USERS = 20_000
#: Pairs whose lists a round moves.
ROUND_PAIRS = 200_000_000


def engaged_events(events: DataFrame) -> DataFrame:
    return events.filter(is_engagement(F.col("event_type")))


def user_items(events: DataFrame) -> DataFrame:
    return engaged_events(events).select("user_id", "item_id").distinct()


def item_support(pairs: DataFrame) -> DataFrame:
    """Number of distinct users per title."""
    return pairs.groupBy("item_id").agg(F.count("*").alias("users"))


def _number_items(visits: DataFrame) -> DataFrame:
    """Titles with their support and a number without gaps that sorts like support, then title id."""
    at = F.monotonically_increasing_id()  # partition and place in it
    ordered = materialize(item_support(visits).orderBy("users", "item_id").withColumn("at", at), "covisit-order")
    part = F.shiftright("at", 33).alias("part")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy(part).agg(F.count("*").alias("n"))
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    kind = "int" if ordered.count() < 2**31 else "bigint"
    number = (F.col("offset") + F.col("at").bitwiseAND((1 << 33) - 1)).cast(kind)
    numbered = ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
    return materialize(numbered.select("item_id", "users", number.alias("item")), "covisit-items")


def _tasks(pairs) -> int:
    return min(max(1, -(-int(pairs or 0) // TASK_PAIRS)), MOST_TASKS)


def _cold(rows: DataFrame, numbers: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The rows of titles that one task can count, and the others with a ``part`` of their users, if there are any: titles
    of more than ``HOT_USERS`` users have the largest numbers."""
    hot_from, most = numbers.filter(F.col("users") > HOT_USERS).agg(F.min("item"), F.max("users")).first()
    if hot_from is None:
        return rows, None
    part = F.pmod(F.xxhash64("user_id"), F.lit(-(-most // HOT_USERS))).cast("int")
    return rows.filter(F.col("a") < hot_from), rows.filter(F.col("a") >= hot_from).withColumn("part", part)


def _counted(placed: DataFrame, *keys: str, beside: tuple[str, ...] = ()) -> DataFrame:
    """(a, b, shared): how often b is in a list that came to a. Rows that are placed by a stay where they are."""
    arrays = [F.get(name, F.col("nth")).alias(name) for name in beside]
    each = placed.select("a", *keys, *beside, F.posexplode("list").alias("nth", "b")).select("a", *keys, "b", *arrays)
    first = [F.first(name).alias(name) for name in beside]
    return each.groupBy("a", *keys, "b").agg(F.count("*").alias("shared"), *first)


def _hot_counted(hot: DataFrame, tasks: int, beside: tuple[str, ...] = ()) -> DataFrame:
    """As ``_counted``, for each part of the users first."""
    parts = _counted(hot.select("a", "part", "list", *beside).repartition(tasks, "a", "part"), "part", beside=beside)
    return parts.groupBy("a", "b").agg(
        F.sum("shared").alias("shared"), *[F.first(name).alias(name) for name in beside]
    )


def _binned(rows: DataFrame, tasks: int):
    """Rows in one group of titles a task."""
    return rows.withColumn("bin", F.pmod(F.xxhash64("a"), F.lit(tasks)).cast("int")).repartition(tasks, "bin").groupBy("bin")


def _first_partners(counts: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` smallest partners of a title among those with the same count, which rank before the others."""
    window = Window.partitionBy("a", "shared").orderBy("b")
    return counts.withColumn("n", F.row_number().over(window)).filter(F.col("n") <= limit).select("a", "b", "shared")


def _lists(visits: DataFrame, *names: str) -> DataFrame:
    """(user_id, list, ...) of the items of each user and of columns beside them, in the same order."""
    gathered = visits.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.collect_list(F.struct("item", *names)).alias("all")
    )
    arrays = [F.col("all.item").alias("list"), *[F.col(f"all.{name}").alias(name) for name in names]]
    return materialize(gathered.select("user_id", *arrays), "covisit-lists")


def _by_small_users(visits: DataFrame, numbers: DataFrame, top_k: int) -> DataFrame:
    """(a, b, shared): the first partners of a among the titles that users share with it."""
    lists = _lists(visits)
    tasks = _tasks(_pairs(lists))
    cold, hot = _cold(lists.select("user_id", F.explode("list").alias("a"), "list"), numbers)
    found = _binned(cold.select("a", "list"), tasks).applyInArrow(first_partners(top_k), PARTNERS)
    if hot is None:
        return found
    return found.unionByName(_first_partners(_hot_counted(hot, tasks).filter("a <> b"), top_k))


def _pairs(lists: DataFrame) -> int:
    return lists.agg(F.sum(F.size("list").cast("long") * F.size("list"))).first()[0] or 0


def _classes(visits: DataFrame) -> DataFrame:
    """Titles of large users with the class of titles that share exactly the same large users.

    A class is told by the number of users and two 64-bit combinations of their hashes, so no list
    of users is gathered anywhere.
    """
    marks = visits.groupBy("item").agg(
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("user_id")).alias("mark_1"),
        F.bit_xor(F.xxhash64(F.lit("other"), "user_id")).alias("mark_2"),
    )
    key = ["size", "mark_1", "mark_2"]
    names = marks.groupBy(*key).agg(F.min("item").alias("class"))
    return marks.join(names, key).select("item", "class")


def _class_lists(members: DataFrame) -> DataFrame:
    """(user_id, class, part, parts, list): each class of a large user with each list of its classes. A user's classes are
    cut into lists of about ``LIST_TITLES``, so a row does not grow with the user's size."""
    parts = F.ceil(F.count("*") / F.lit(LIST_TITLES)).cast("int").alias("parts")
    split = members.join(members.groupBy("user_id").agg(parts), "user_id")
    of_class = F.struct("class", "cold_bins", "hot")
    return materialize(
        split.groupBy("user_id", "parts", F.pmod(F.xxhash64("class"), "parts").cast("int").alias("part")).agg(
            F.collect_list("class").alias("list"), F.collect_list(of_class).alias("sources")
        ),
        "covisit-class-lists",
    )


def _class_rows(lists: DataFrame) -> DataFrame:
    """(user_id, a, cold_bins, hot, list): every class of a user with every list of its classes."""
    source = F.explode("sources").alias("source")
    names = ["user_id", F.col("source.class").alias("a"), "source.cold_bins", "source.hot"]
    whole = lists.filter("parts = 1").select("user_id", source, "list").select(*names, "list")
    if lists.filter("parts > 1").isEmpty():
        return whole
    cut = lists.filter("parts > 1")
    each = cut.select("user_id", source, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    joined = each.select(*names, "part").join(cut.select("user_id", "part", "list"), ["user_id", "part"])
    return whole.unionByName(joined.select("user_id", "a", "cold_bins", "hot", "list"))


def _places(numbers: DataFrame, classes: DataFrame, members: DataFrame, pair_limit: int, tasks: int) -> DataFrame:
    """(item, class, hot, bin): where the pairs of each title are counted. ``hot`` titles are counted in parts of their
    users: those of many, and of classes that meet more classes than a task counts. Titles of a class share bins, as far
    as the lists that come to them fit in one task."""
    sizes = members.groupBy("user_id").agg(F.count("*").alias("size"))
    met = members.join(sizes, "user_id").groupBy("class").agg(F.sum("size").alias("met"))
    of_item = (
        numbers.filter(F.col("item_id").isNotNull()).join(classes, "item", "left").join(met, "class", "left")
        .select("item", "users", "class", ((F.col("users") > HOT_USERS) | (F.coalesce("met", F.lit(0)) > 2 * TASK_PAIRS)).alias("hot"))
    )
    of_item = materialize(of_item, "covisit-heat")
    load = F.greatest(F.sum("users") * F.lit(pair_limit) / F.lit(TASK_PAIRS), F.count("*") / F.lit(LIST_TITLES))
    chunks = (
        of_item.filter(~F.col("hot") & F.col("class").isNotNull()).groupBy("class")
        .agg(F.ceil(load).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("item"), F.col("chunks"))
    home = F.when(F.col("class").isNull(), F.xxhash64("item")).otherwise(F.xxhash64("class", chunk))
    return materialize(
        of_item.join(chunks, "class", "left").select("item", "class", "hot", F.pmod(home, F.lit(tasks)).cast("int").alias("bin")),
        "covisit-places",
    )


def _hot_partners(rows: DataFrame, overlaps: DataFrame, places: DataFrame, top_k: int, tasks: int) -> DataFrame:
    """(a, b, shared, bin, of_class) of hot titles, as ``first_with_classes`` gives it, but for each title and without a bin."""
    of_title = places.filter(F.col("hot") & F.col("class").isNotNull()).select(F.col("item").alias("a"), F.col("class").alias("class_a"))
    large = of_title.join(overlaps, "class_a").select("a", "class", "overlap")
    counts = _hot_counted(rows, tasks, ("class",)).filter("a <> b").join(large, ["a", "class"], "left")
    whole = (F.col("shared") + F.coalesce("overlap", F.lit(0))).alias("shared")
    first = _first_partners(large.select("a", F.col("class").alias("b"), F.col("overlap").alias("shared")), top_k + 1)
    titles = _first_partners(counts.select("a", "b", whole), top_k).withColumn("of_class", F.lit(False))
    found = titles.unionByName(first.withColumn("of_class", F.lit(True)))
    return found.select("a", "b", "shared", F.lit(None).cast("int").alias("bin"), "of_class")


def _by_all_users(
    small: DataFrame, large: DataFrame, numbers: DataFrame, classes: DataFrame, top_k: int, pair_limit: int
) -> DataFrame:
    """(a, b, shared): the first partners of a among the titles that small users share with it, and the best members of
    the first classes among those that large users share with it."""
    spark = numbers.sparkSession
    members = large.join(classes.filter("item = class").select("item", "class"), "item").select("user_id", "class")
    members = materialize(members, "covisit-members")
    squares = lambda visits: visits.groupBy("user_id").count().agg(F.sum(F.col("count") * F.col("count"))).first()[0] or 0
    pairs = squares(small.filter(F.col("user_id").isNotNull())) + squares(members)
    tasks, rounds = _tasks(pairs), max(1, -(-pairs // ROUND_PAIRS))
    places = _places(numbers, classes, members, pair_limit, tasks)
    bins = F.collect_set(F.when(~F.col("hot"), F.col("bin"))).alias("cold_bins")
    of_class = places.filter(F.col("class").isNotNull()).groupBy("class").agg(bins, F.max("hot").alias("hot"))
    each = _lists(small.join(places, "item"), "class", "hot", "bin").select(
        "user_id", F.posexplode("list").alias("nth", "a"), "list", "class", "hot", "bin"
    )
    each = each.select(
        "user_id", "a", "list", "class",
        *[F.get(name, F.col("nth")).alias(own) for name, own in (("class", "own"), ("hot", "heat"), ("bin", "place"))],
    )
    of_users = _class_rows(_class_lists(members.join(of_class, "class")))
    most_users = numbers.filter("item_id IS NOT NULL").agg(F.max("users")).first()[0] or 1
    part = F.pmod(F.xxhash64("user_id"), F.lit(-(-most_users // HOT_USERS))).cast("int").alias("part")
    any_hot = not places.filter("hot").isEmpty()

    path = fresh_path(spark, "covisit-rounds")
    for number in range(rounds):
        here = lambda key: F.pmod(key, F.lit(rounds)) == number
        cold = each.filter(~F.col("heat") & here(F.col("place"))).select("a", "own", F.col("place").alias("bin"), "list", "class")
        met = of_users.select("a", F.explode("cold_bins").alias("bin"), "list").filter(here(F.col("bin")))
        cold, met = (side.repartition(-(-tasks // rounds), "bin").groupBy("bin") for side in (cold, met))
        cold.cogroup(met).applyInArrow(first_with_classes(top_k), CLASS_PARTNERS).write.mode("append").parquet(path)
        if any_hot:
            rows = each.filter(F.col("heat") & here(F.xxhash64(F.coalesce("own", "a")))).select("a", part, "list", "class")
            met = of_users.filter(F.col("hot") & here(F.xxhash64("a"))).select("a", part, "list")
            here_only = fresh_path(spark, "covisit-overlaps")
            overlaps = _hot_counted(met, tasks).toDF("class_a", "class", "overlap")
            overlaps.write.parquet(here_only)
            overlaps = spark.read.schema(overlaps.schema).parquet(here_only)
            _hot_partners(rows, overlaps, places, top_k, tasks).write.mode("append").parquet(path)
            remove(spark, here_only)
    return _unfolded(spark.read.schema(CLASS_PARTNERS).parquet(path), places, classes, top_k)


def _unfolded(found: DataFrame, places: DataFrame, classes: DataFrame, top_k: int) -> DataFrame:
    """(a, b, shared): found titles, and the best members of found classes. A class is named by its member that ranks first."""
    in_class = Window.partitionBy("class").orderBy("item")
    best = (
        classes.withColumn("n", F.row_number().over(in_class)).filter(F.col("n") <= top_k + 1)
        .select("class", F.col("item").alias("b"))
    )
    titles = places.filter(~F.col("hot")).select(F.col("item").alias("title"), F.col("class").alias("a"), "bin")
    by_class = found.filter("of_class").select("a", F.col("b").alias("class"), "shared", "bin")
    by_class = (
        by_class.filter("bin IS NOT NULL").join(titles, ["a", "bin"]).select(F.col("title").alias("a"), "class", "shared")
        .unionByName(by_class.filter("bin IS NULL").select("a", "class", "shared"))
    )
    by_members = by_class.join(best, "class").filter("a <> b").select("a", "b", "shared")
    return found.filter("NOT of_class").select("a", "b", "shared").unionByName(by_members)


def covisit_edges(visits: DataFrame, top_k: int = 8, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Best neighbours of every title: shared users, users of both sides and the cosine.

    Rank is by shared² / users of the neighbour, which orders like the cosine and is the same on any
    engine; ties go to the smaller title id.
    """
    with shuffle_files_removed(visits.sparkSession):
        visits = materialize(visits, "covisit-visits")
        numbers = _number_items(visits)
        large = visits.groupBy("user_id").count().filter(F.col("count") > pair_limit).select("user_id")
        numbered = visits.join(numbers, "item_id").select("user_id", "item")
        if large.isEmpty():
            found = _by_small_users(numbered, numbers, top_k)
        else:
            large = materialize(large, "covisit-large-users")
            large_visits = materialize(numbered.join(large, "user_id", "left_semi"), "covisit-large-visits")
            classes = materialize(_classes(large_visits), "covisit-classes")
            small = numbered.join(large, "user_id", "left_anti")
            both = _by_all_users(small, large_visits, numbers, classes, top_k, pair_limit)
            # A pair that small users share as well has its whole count among the partners by small users.
            found = both.groupBy("a", "b").agg(F.max("shared").alias("shared"))
        found = materialize(found, "covisit-found")
    sources = numbers.select(
        F.col("item").alias("a"), F.col("item_id").alias("source_item_id"), F.col("users").alias("source_users")
    )
    targets = numbers.select(
        F.col("item").alias("b"), F.col("item_id").alias("neighbor_item_id"), F.col("users").alias("neighbor_users")
    )
    rank = F.col("shared") * F.col("shared") / F.col("neighbor_users")
    window = Window.partitionBy("a").orderBy(rank.desc(), "neighbor_item_id")
    best = found.join(targets, "b").withColumn("n", F.row_number().over(window)).filter(F.col("n") <= top_k)
    return best.join(sources, "a").select(
        "source_item_id",
        "neighbor_item_id",
        F.col("shared").alias("shared_users"),
        "source_users",
        "neighbor_users",
        F.round(F.col("shared") / F.sqrt(F.col("source_users") * F.col("neighbor_users")), 6).alias("score"),
    )


def collaborative_neighbors(events: DataFrame, top_k: int = 8, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    edges = covisit_edges(user_items(events), top_k, pair_limit)
    return edges.select(
        "source_item_id", "neighbor_item_id", "score", F.lit("collaborative").alias("algorithm")
    )
