"""Recommendations for all users, or some, as one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import candidates as C
from marquee.operators import ranking as R


@dataclass
class ServingTables:
    users: DataFrame
    items: DataFrame
    recent: DataFrame
    watched: DataFrame
    affinity: DataFrame
    neighbors: DataFrame
    trending: DataFrame
    versions: DataFrame | None = None

    def only(self, users: DataFrame) -> ServingTables:
        """The tables reduced to the given users; title tables are unchanged."""

        def keep(table: DataFrame) -> DataFrame:
            return table.join(users.select("user_id"), "user_id", "left_semi")

        return ServingTables(
            keep(self.users), self.items, keep(self.recent), keep(self.watched), keep(self.affinity),
            self.neighbors, self.trending, self.versions,
        )

    def only_user(self, user_id: str) -> ServingTables:
        """As ``only`` for one user, as a filter that reaches every scan."""

        def keep(table: DataFrame) -> DataFrame:
            return table.filter(F.col("user_id") == user_id)

        return ServingTables(
            keep(self.users), self.items, keep(self.recent), keep(self.watched), keep(self.affinity),
            self.neighbors, self.trending, self.versions,
        )


def merged_candidates(tables: ServingTables, **session) -> DataFrame:
    """(user, title) with raw scores per source, for known users only."""
    known = tables.recent.join(tables.users.select("user_id"), "user_id", "left_semi")
    return C.candidate_matrix(
        C.candidates(tables.users, known, tables.neighbors, tables.trending, tables.items, **session)
    )


def scored_candidates(
    tables: ServingTables, weights: dict[str, float] | None = None, strict_regions: bool = False, **session
) -> DataFrame:
    """Candidates that passed all guardrails, with components, blend and reason.

    One shuffle, by user, carries the candidates; merging, normalising, the watched list, profile, taste
    and both rankings use that placement (with the settings of ``session.prepare``). Watched titles count
    for the normalisation and are dropped after it.
    """
    profile = tables.users.select("user_id", "region", F.col("maturity_rating").alias("user_rating"))
    unwatched = R.unwatched(C.normalized(merged_candidates(tables, **session)), tables.watched)
    with_profile = R.with_known_titles(unwatched).join(profile, "user_id")
    with_taste = R.pass_guardrails(with_profile, strict_regions).join(
        R.affinity_maps(tables.affinity), "user_id", "left"
    )
    return R.blended(with_taste, weights)


def recommend(tables: ServingTables, limit: int = 10, **options) -> DataFrame:
    """Ranked recommendations, one row per (user, position)."""
    return R.served(R.best(R.diverse(scored_candidates(tables, **options)), limit))


def unknown_users(asked: DataFrame, users: DataFrame) -> DataFrame:
    """The rows of ``asked`` whose user is not registered; they get no recommendations."""
    return asked.join(users.select("user_id"), "user_id", "left_anti")


def latest_version(versions: DataFrame) -> DataFrame:
    """One row with the newest version, 'untrained' when there is none."""
    return versions.agg(F.coalesce(F.max_by("version", "created_at"), F.lit("untrained")).alias("model_version"))


def recommend_nested(
    tables: ServingTables, limit: int = 10, context: str = "home", **options
) -> DataFrame:
    """One document per user: recent titles and an array of explained recommendations."""
    components = F.struct(*R.BLEND_WEIGHTS)
    entry = F.struct(
        "position", "item_id", "title", F.split("genres", ",").alias("genres"), "score", "reason",
        components.alias("components"),
    )
    rows = recommend(tables, limit, **options).groupBy("user_id").agg(
        F.sort_array(F.collect_list(entry)).alias("ranked")
    )
    recent = (
        tables.recent.filter(F.col("position") <= C.RECENT_FOR_RANKING).groupBy("user_id")
        .agg(F.sort_array(F.collect_list(F.struct("position", "item_id"))).alias("recent"))
    )
    version = F.lit("untrained")
    if tables.versions is not None:
        version = latest_version(tables.versions).scalar()
    return (
        tables.users.select("user_id").join(rows, "user_id", "left").join(recent, "user_id", "left")
        .select(
            "user_id",
            F.lit(context).alias("context"),
            version.alias("model_version"),
            F.coalesce(F.col("recent.item_id"), F.array().cast("array<string>")).alias("recent_items"),
            F.transform(F.coalesce("ranked", F.array()), lambda one: one.dropFields("position"))
            .alias("recommendations"),
        )
    )
