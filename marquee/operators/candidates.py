"""Candidate generation: neighbours of recent titles, session, regional trending.

Facts that the ranking needs about a title travel with the candidate from the start, because they are
attached to the small side (titles and their neighbour lists) rather than to users times candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.weights import WEIGHT_TYPE

SOURCES = ("collaborative", "content", "session", "trending")
# The session signal reads five titles and loses 0.7 per step.
SESSION_LENGTH = 5
SESSION_DECAY = (1.0, 0.7, 0.7 * 0.7, 0.7 * 0.7 * 0.7, 0.7 * 0.7 * 0.7 * 0.7)
RECENT_FOR_RANKING = 10
MOST_REGIONS = 10_000
MOST_HOT = 1_000

FACTS = ("title", "genres", "release_year", "maturity_rating", "available_regions", "is_active")


def item_facts(items: DataFrame) -> DataFrame:
    """(item_id, facts): what guardrails and scoring need to know about a title."""
    return items.select("item_id", F.struct(*FACTS).alias("facts"))


def session_score(position: Column, count: Column, newest_first: bool = True) -> Column:
    """Decay over the five oldest of the recent titles, the oldest first.

    ``newest_first=False`` favours the newest titles instead.
    """
    step = (count - position) if newest_first else (position - 1)
    decay = F.array(*[F.lit(value) for value in SESSION_DECAY])
    return F.when(step < SESSION_LENGTH, F.get(decay, step.cast("int")))


def recent_with_session(recent: DataFrame, limit: int = RECENT_FOR_RANKING, newest_first: bool = True) -> DataFrame:
    """(user_id, item_id, position, session_score) for the titles that ranking reads."""
    per_user = Window.partitionBy("user_id")
    return (
        recent.filter(F.col("position") <= limit)
        .withColumn("n", F.count("*").over(per_user))
        .select(
            "user_id", "item_id", "position",
            session_score(F.col("position"), F.col("n"), newest_first).alias("session_score"),
        )
    )


def session_scores(recent: DataFrame, **options) -> DataFrame:
    return recent_with_session(recent, **options).filter(F.col("session_score").isNotNull()).select(
        "user_id", "item_id", F.col("session_score").alias("score")
    )


def _neighbor_lists(neighbors: DataFrame, facts: DataFrame) -> DataFrame:
    """(item_id, near): all edges of a title in one row, each with the facts of the neighbour.

    A list has at most ``top_k`` edges per algorithm, the number that training keeps.
    """
    edges = neighbors.join(facts.withColumnRenamed("item_id", "neighbor_item_id"), "neighbor_item_id", "left")
    one = F.struct(
        F.col("neighbor_item_id").alias("item_id"), F.col("algorithm").alias("source"), "score", "facts"
    )
    return edges.groupBy(F.col("source_item_id").alias("item_id")).agg(F.collect_list(one).alias("near"))


def _from_recent(recent: DataFrame, neighbors: DataFrame, facts: DataFrame) -> DataFrame:
    """Session candidates and the neighbours of recent titles, in one lookup by title.

    The lookup has one row per title that is recent for somebody. A title that holds more than one in ``MOST_HOT`` of all
    recent rows is hot: there are fewer than that many, and their lists go to every task, so the rows stay where they are,
    by user. The other titles meet their rows in a join in which no title is large.
    """
    counts = recent.groupBy("item_id").agg(F.count("*").alias("n"))
    is_hot = F.col("n") * MOST_HOT > counts.agg(F.sum("n")).scalar()
    asked = counts.select("item_id", is_hot.alias("hot"))
    known = facts.select("item_id", "facts").join(asked.select("item_id"), "item_id", "left_semi")
    sources = asked.select(F.col("item_id").alias("source_item_id"))
    lists = _neighbor_lists(neighbors.join(sources, "source_item_id", "left_semi"), facts)
    lookup = known.join(lists, "item_id", "full_outer").join(asked, "item_id")
    hot_titles = F.broadcast(asked.filter("hot").select("item_id"))
    itself = F.struct(
        "item_id", F.lit("session").alias("source"), F.col("session_score").alias("score"), "facts"
    )
    rows = F.when(F.col("session_score").isNotNull(), F.array(itself)).otherwise(F.array())

    def unfolded(joined: DataFrame) -> DataFrame:
        return joined.select("user_id", F.inline(F.concat(rows, F.coalesce("near", F.array()))))

    of_hot = recent.join(F.broadcast(lookup.filter("hot")), "item_id")
    of_others = recent.join(hot_titles, "item_id", "left_anti").join(lookup.filter("NOT hot"), "item_id")
    return unfolded(of_hot).unionByName(unfolded(of_others))


def _from_trending(users: DataFrame, trending: DataFrame, facts: DataFrame) -> DataFrame:
    """Every user of a region is offered the region's trending titles (at most ten).

    There is one row per region. Up to ``MOST_REGIONS`` of them, counted here, go to every task, so users stay where
    they are; more regions are joined by region.
    """
    one = F.struct("item_id", F.lit("trending").alias("source"), "score", "facts")
    per_region = trending.join(facts, "item_id", "left").groupBy("region").agg(F.collect_list(one).alias("hot"))
    if trending.select("region").distinct().count() <= MOST_REGIONS:
        per_region = F.broadcast(per_region)
    return users.select("user_id", "region").join(per_region, "region").select("user_id", F.inline("hot"))


def candidates(
    users: DataFrame, recent: DataFrame, neighbors: DataFrame, trending: DataFrame, items: DataFrame, **session
) -> DataFrame:
    """(user_id, item_id, source, score, facts) before scores of equal source are added up."""
    facts = item_facts(items)
    return _from_recent(recent_with_session(recent, **session), neighbors, facts).unionByName(
        _from_trending(users, trending, facts)
    )


def neighbor_scores(found: DataFrame) -> DataFrame:
    """(user_id, item_id, source, score): edge scores added up over the user's recent titles."""
    edges = found.filter(F.col("source").isin("collaborative", "content"))
    total = F.sum(F.col("score").cast(WEIGHT_TYPE)).cast("double")
    return edges.groupBy("user_id", "item_id", "source").agg(total.alias("score"))


def candidate_matrix(found: DataFrame) -> DataFrame:
    """One row per (user, title) with the summed score per source, 0 where a source has no say.

    One grouping replaces the outer joins of four score lists. Rows are placed by user, where all later
    steps need them; a user has at most 180. Scores of edges are added as decimals, so the sum does not
    depend on order.
    """
    totals = []
    for name in SOURCES:
        own = F.when(F.col("source") == name, F.col("score"))
        if name in ("collaborative", "content"):
            total = F.coalesce(F.sum(own.cast(WEIGHT_TYPE)).cast("double"), F.lit(0.0))
        else:
            total = F.coalesce(F.max(own), F.lit(0.0))
        totals.append(total.alias(name))
    by_user = found.repartition("user_id")
    return by_user.groupBy("user_id", "item_id").agg(*totals, F.first("facts", ignorenulls=True).alias("facts"))


def normalized(matrix: DataFrame) -> DataFrame:
    """Scores divided by the user's largest of the source, taken over all candidates."""
    per_user = Window.partitionBy("user_id")

    def scaled(name: str) -> Column:
        largest = F.max(name).over(per_user)
        return F.col(name) / F.when(largest == 0.0, F.lit(1.0)).otherwise(largest)

    return matrix.withColumns({name: scaled(name) for name in SOURCES})
