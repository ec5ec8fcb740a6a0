"""Registered queries, each next to the SQL that states its result."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.sql import statement
from marquee.functions import scoring, weights
from marquee.functions.text import corpus_text, csv_list, tokens
from marquee.operators import candidates as C
from marquee.operators import choice, content, covisit, covisit_view, features, rates, trending
from marquee.operators import ranking as R
from marquee.plans import recommend as P
from marquee.plans import train as T
from marquee.plans.features import user_features
from marquee.plans.serving import Requests, write_layout
from marquee.session import fresh_path, materialize, prepare
from marquee.sources import archive, events
from marquee.sources import star_schema as S
from marquee.streaming import ingest as I
from marquee.streaming import rates as streaming_rates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @functools.wraps(function)
        def run(spark: SparkSession, root: str) -> DataFrame:
            prepare(spark)
            return function(spark, root)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = statement(sql)
        return function

    return register


_shared: dict[tuple, object] = {}


def shared(kind: str, spark: SparkSession, root: str, build: Callable[[], object]):
    """Build a result that many queries read once per session and data folder."""
    key = (kind, spark.sparkContext.applicationId, root)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def as_of(spark, root):
    return S.interactions(spark, root).agg(F.max("event_ts")).scalar()


def last_event(spark, root):
    return S.interactions(spark, root).agg(F.max("event_ts")).first()[0]


def trained(spark, root) -> T.TrainedTables:
    def build():
        tables = T.train(S.items(spark, root), S.interactions(spark, root), as_of(spark, root))
        return T.TrainedTables(materialize(tables.neighbors, "neighbors"), materialize(tables.trending, "trending"))

    return shared("trained", spark, root, build)


def summary(spark, root):
    return features.user_item_summary(S.interactions(spark, root), S.items(spark, root))


def recent(spark, root, limit=20):
    return features.recent_items(features.last_seen(summary(spark, root)), limit)


def published(spark, root) -> str:
    """Folder of a published model."""

    def build():
        path = fresh_path(spark, "served-model")
        T.publish(trained(spark, root), path, last_event(spark, root))
        return path

    return shared("published", spark, root, build)


def serving_published(spark, root) -> P.ServingTables:
    """As ``serving``, with neighbours, trending titles and version from the published model."""
    path = published(spark, root)
    model = T.read_published(spark, path)
    return dataclasses.replace(
        serving(spark, root), neighbors=model.neighbors, trending=model.trending, versions=T.versions(spark, path)
    )


def serving(spark, root) -> P.ServingTables:
    items, model = S.items(spark, root), trained(spark, root)
    stored = shared("features", spark, root, lambda: user_features(S.interactions(spark, root), items))
    return P.ServingTables(
        users=S.users(spark, root), items=items, recent=stored.recent, watched=stored.watched,
        affinity=stored.affinity, neighbors=model.neighbors, trending=model.trending,
    )


def newest_user(spark, root) -> str:
    newest = F.max_by("user_id", F.struct("event_ts", "event_id"))
    return shared("newest-user", spark, root, lambda: S.interactions(spark, root).agg(newest).first()[0])


def requests(spark, root) -> Requests:
    """The stored layout for single requests."""

    def build():
        path = fresh_path(spark, "serving-layout")
        write_layout(serving(spark, root), path, buckets=8)
        return Requests(spark, path)

    return shared("requests", spark, root, build)


def profiled(spark, root):
    tables = serving(spark, root)
    profile = tables.users.select("user_id", "region", F.col("maturity_rating").alias("user_rating"))
    unwatched = R.unwatched(C.normalized(P.merged_candidates(tables)), tables.watched)
    return R.with_known_titles(unwatched).join(profile, "user_id")


def as_double(*names):
    return [F.round(F.col(name).cast("double"), 6).alias(name) for name in names]


COMPONENTS = ("collaborative", "content", "session", "trending")
INTER = "SELECT * FROM inter"


# --- sources, decoding, sinks -------------------------------------------------------------------

query("scan_interactions", INTER)(S.interactions)
query("scan_items", "SELECT * FROM items")(S.items)
query("scan_users", "SELECT * FROM users")(S.users)


def _plain(df: DataFrame) -> DataFrame:
    """Columns of the interaction table with event time as the batch tables have it."""
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz")).select(*events.MESSAGE_FIELDS)


@query("decode_events", INTER)
def _(spark, root):
    return _plain(events.usable(events.decode(events.encode(S.interactions(spark, root)))))


@query("encode_keyed", """SELECT user_id AS key, event_id, strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS stamp
    FROM inter""")
def _(spark, root):
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return events.encode(S.interactions(spark, root)).select(
        "key", field("event_id").alias("event_id"), field("event_ts").alias("stamp")
    )


def damaged_messages(interactions: DataFrame) -> DataFrame:
    """Messages of which some are cut short, lack the region or the user, or have no usable time or percentage."""
    kind = F.col("event_type")
    few = lambda name: (kind == name) & (F.col("watch_seconds") < 40)
    changed = {
        "region": F.when(few("click"), None).otherwise(F.col("region")),
        "user_id": F.when(few("watchlist_add"), "").otherwise(F.col("user_id")),
        "completion_pct": F.when(few("play_start"), "NaN").otherwise(F.col("completion_pct").cast("string")),
        "event_ts": F.when(few("complete"), "yesterday").when(few("watch_progress"), "12:30").otherwise(
            F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        ),
    }
    fields = [changed.get(name, F.col(name)).alias(name) for name in events.MESSAGE_FIELDS]
    text = F.to_json(F.struct(*fields))
    return interactions.select(
        F.when(few("impression"), F.substr(text, F.lit(1), F.length(text) - 9)).otherwise(text).alias("value")
    )


@query("quarantine_split", """SELECT CASE WHEN watch_seconds >= 40 THEN 'usable'
    WHEN event_type = 'impression' THEN 'malformed' WHEN event_type = 'click' THEN 'missing region'
    WHEN event_type IN ('complete', 'watch_progress') THEN 'bad event_ts'
    WHEN event_type = 'watchlist_add' THEN 'missing user_id'
    WHEN event_type = 'play_start' THEN 'bad completion_pct' ELSE 'usable' END AS problem, count(*) AS n
    FROM inter GROUP BY 1""")
def _(spark, root):
    decoded = events.decode(damaged_messages(S.interactions(spark, root)))
    return decoded.groupBy(F.coalesce("problem", F.lit("usable")).alias("problem")).agg(F.count("*").alias("n"))


def _write_archive(spark, root):
    path = fresh_path(spark, "archive")
    archive.write_archive(events.usable(events.decode(events.encode(S.interactions(spark, root)))), path)
    return path


@query("raw_archive", """SELECT strftime(event_ts, '%Y') AS year, strftime(event_ts, '%m') AS month,
    strftime(event_ts, '%d') AS day, strftime(event_ts, '%H') AS hour, count(*) AS n
    FROM inter GROUP BY 1, 2, 3, 4""")
def _(spark, root):
    stored = archive.read_archive(spark, _write_archive(spark, root))
    return stored.groupBy(*archive.HOUR_PARTS).agg(F.count("*").alias("n"))


@query("replay_hour", """SELECT event_id, user_id FROM inter WHERE strftime(event_ts, '%Y%m%d%H')
    BETWEEN strftime((SELECT t FROM as_of) - INTERVAL 24 HOUR, '%Y%m%d%H')
    AND strftime((SELECT t FROM as_of), '%Y%m%d%H')""")
def _(spark, root):
    end = last_event(spark, root)
    path = _write_archive(spark, root)
    return archive.replay(spark, path, end - timedelta(hours=24), end + timedelta(hours=1)).select("event_id", "user_id")


def _sent_twice(spark, root):
    once = S.interactions(spark, root).withColumn("arrival", F.lit(0))
    return once.unionByName(once.withColumn("arrival", F.lit(1)).withColumn("device_type", F.lit("resent")))


@query("dedup_interactions", INTER)
def _(spark, root):
    return events.first_arrivals(_sent_twice(spark, root), "arrival").drop("arrival")


@query("load_facts", INTER)
def _(spark, root):
    path = fresh_path(spark, "facts")
    events.append_facts(S.interactions(spark, root), path)
    events.append_facts(_sent_twice(spark, root), path, "arrival")
    return spark.read.parquet(path).select(*events.MESSAGE_FIELDS)


@query("load_if_empty", "SELECT * FROM items")
def _(spark, root):
    path, rows = fresh_path(spark, "seed"), S.items(spark, root)
    T.load_if_empty(rows, path)
    T.load_if_empty(rows.withColumn("title", F.lit("second load")), path)
    return spark.read.parquet(path)


@query("model_version", """SELECT 'hybrid-' || strftime(max(ts), '%Y%m%d%H%M%S') AS version,
    'co-occurrence + tfidf hybrid' AS description, max(ts) AS created_at FROM events""")
def _(spark, root):
    return T.version_record(spark, last_event(spark, root))


@query("train_publish", "SELECT * FROM neighbors UNION ALL SELECT region, item_id, score, 'trending' FROM trending")
def _(spark, root):
    path, stamp = fresh_path(spark, "model"), last_event(spark, root)
    full = trained(spark, root)
    earlier = T.TrainedTables(full.neighbors.filter("algorithm = 'content'"), full.trending.filter("score > 5"))
    T.publish(earlier, path, stamp - timedelta(minutes=1))
    T.publish(full, path, stamp)
    tables = T.read_published(spark, path)
    return tables.neighbors.unionByName(tables.trending.select(
        F.col("region").alias("source_item_id"), F.col("item_id").alias("neighbor_item_id"), "score",
        F.lit("trending").alias("algorithm"),
    ))


# --- filters and expressions --------------------------------------------------------------------

@query("active_items", "SELECT * FROM items WHERE is_active")
def _(spark, root):
    return content.active_items(S.items(spark, root))


@query("engaged_events", "SELECT * FROM engaged")
def _(spark, root):
    return covisit.engaged_events(S.interactions(spark, root))


@query("events_last_24h", "SELECT * FROM inter WHERE event_ts >= (SELECT t FROM as_of) - INTERVAL 24 HOUR")
def _(spark, root):
    return trending.last_hours(S.interactions(spark, root), as_of(spark, root))


@query("watched_flags", "SELECT event_id, is_watched AS watched FROM weighted")
def _(spark, root):
    flag = weights.is_watched(F.col("event_type"), F.col("completion_pct"), F.col("watch_seconds"))
    return S.interactions(spark, root).select("event_id", flag.alias("watched"))


@query("known_item_events", "SELECT event_id, item_id FROM known")
def _(spark, root):
    return features.known_events(S.interactions(spark, root), S.items(spark, root)).select("event_id", "item_id")


@query("enrich_events", "SELECT event_id, item_id, title, genres FROM inter JOIN items USING (item_id)")
def _(spark, root):
    titled = features.titled_events(S.interactions(spark, root), S.items(spark, root))
    return titled.select("event_id", "item_id", "title", "genres")


@query("interaction_weight", "SELECT event_id, CAST(weight AS DOUBLE) AS weight FROM weighted")
def _(spark, root):
    weight = weights.interaction_weight(F.col("event_type"), F.col("completion_pct")).cast("double")
    return S.interactions(spark, root).select("event_id", weight.alias("weight"))


@query("online_increment", "SELECT event_id, CAST(increment AS DOUBLE) AS increment FROM weighted")
def _(spark, root):
    increment = weights.online_increment(F.col("event_type")).cast("double")
    return S.interactions(spark, root).select("event_id", increment.alias("increment"))


@query("completion_pct", """SELECT event_id, CASE WHEN event_type IN ('play_start', 'watch_progress', 'complete')
    THEN round(least(100.0::DOUBLE, watch_seconds::DOUBLE
        / CASE item_type WHEN 'series' THEN 2700 ELSE 6600 END * 100.0::DOUBLE), 2) ELSE 0.0::DOUBLE END AS completion
    FROM inter JOIN items USING (item_id)""")
def _(spark, root):
    types = S.items(spark, root).select("item_id", "item_type")
    share = weights.completion_percent(F.col("event_type"), F.col("item_type"), F.col("watch_seconds"))
    return S.interactions(spark, root).join(types, "item_id").select("event_id", share.alias("completion"))


@query("freshness", """SELECT item_id, least(greatest(CAST(release_year - 2020 AS DOUBLE) / 6.0, 0.0), 1.0)
    AS freshness FROM items""")
def _(spark, root):
    return S.items(spark, root).select("item_id", scoring.freshness(F.col("release_year")).alias("freshness"))


@query("item_genres", "SELECT item_id, genre FROM item_genre")
def _(spark, root):
    return S.items(spark, root).select("item_id", F.explode(csv_list(F.col("genres"))).alias("genre"))


@query("item_corpus", "SELECT * FROM corpus")
def _(spark, root):
    return content.item_corpus(S.items(spark, root))


@query("tokens", "SELECT * FROM it_tok")
def _(spark, root):
    return S.items(spark, root).filter("is_active").select(
        "item_id", F.explode(tokens(corpus_text())).alias("term")
    )


@query("document_tokens", "SELECT item_id, term, tf FROM dc_tf")
def _(spark, root):
    return content.term_counts(S.documents(spark, root))


@query("tf_df", "SELECT item_id, term, tf, df FROM it_raw")
def _(spark, root):
    counts = content.term_counts(content.item_corpus(S.items(spark, root)))
    return content.with_frequency(counts).select("item_id", "term", "tf", "df")


@query("tfidf_weights", "SELECT item_id, term, round(weight, 6) AS weight FROM it_w")
def _(spark, root):
    return content.tfidf(content.item_corpus(S.items(spark, root))).select(
        "item_id", "term", F.round("weight", 6).alias("weight")
    )


@query("deterministic_score", """SELECT event_id, CAST(('0x' || substr(md5(user_id || '|' || item_id), 1, 8))
    AS BIGINT)::DOUBLE / 4294967295.0::DOUBLE AS score FROM inter""")
def _(spark, root):
    return S.interactions(spark, root).select(
        "event_id", scoring.deterministic_score(F.col("user_id"), F.col("item_id")).alias("score")
    )


@query("hash_holdout", """SELECT event_id, CAST(('0x' || substr(md5(user_id), 1, 8)) AS BIGINT)::DOUBLE
    / 4294967295.0::DOUBLE < 0.2::DOUBLE AS held_out FROM inter""")
def _(spark, root):
    return choice.with_holdout(S.interactions(spark, root), "user_id").select("event_id", "held_out")


@query("cold_start_scores", "SELECT * FROM cold")
def _(spark, root):
    pairs = summary(spark, root).select("user_id", "item_id")
    return choice.cold_start_scores(pairs, S.genre_priors(spark, root), S.items(spark, root))


@query("weighted_sample", """SELECT user_id, item_id, score FROM cold QUALIFY row_number() OVER (PARTITION BY user_id
    ORDER BY round(ln(greatest(CAST(('0x' || substr(md5(user_id || '|' || item_id), 1, 8)) AS BIGINT)::DOUBLE
    / 4294967295.0::DOUBLE, 1e-12)) / score, 9) DESC, item_id) <= 1""")
def _(spark, root):
    return choice.weighted_choice(QUERIES["cold_start_scores"](spark, root), "user_id", "item_id", "score")


# --- features -----------------------------------------------------------------------------------

@query("last_seen", "SELECT user_id, item_id, last_ts, epoch_us(last_ts) / 1e6::DOUBLE AS epoch_seconds FROM seen")
def _(spark, root):
    epoch = F.unix_micros(F.col("last_ts").cast("timestamp")) / F.lit(1e6)
    return features.last_seen(summary(spark, root)).withColumn("epoch_seconds", epoch)


@query("recent_20", "SELECT * FROM recent WHERE position <= 20")
def _(spark, root):
    return recent(spark, root).withColumn("position", F.col("position").cast("long"))


@query("recent_10", "SELECT * FROM recent WHERE position <= 10")
def _(spark, root):
    return recent(spark, root, 10).withColumn("position", F.col("position").cast("long"))


@query("watched_items", "SELECT * FROM watched")
def _(spark, root):
    return features.watched_items(summary(spark, root))


@query("genre_affinity", "SELECT user_id, genre, CAST(affinity AS DOUBLE) AS affinity FROM affinity")
def _(spark, root):
    affinity = features.genre_affinity(summary(spark, root), S.items(spark, root))
    return affinity.select("user_id", "genre", F.col("affinity").cast("double").alias("affinity"))


POPULARITY = """SELECT region, item_id, CAST(sum(increment) AS DOUBLE) AS popularity FROM known GROUP BY 1, 2"""


@query("regional_popularity", POPULARITY)
def _(spark, root):
    sums = features.regional_popularity(S.interactions(spark, root), S.items(spark, root))
    return sums.select("region", "item_id", F.col("popularity").cast("double").alias("popularity"))


# --- training -----------------------------------------------------------------------------------

@query("user_items", "SELECT * FROM visits")
def _(spark, root):
    return covisit.user_items(S.interactions(spark, root))


@query("item_support", "SELECT * FROM cv_n")
def _(spark, root):
    return covisit.item_support(covisit.user_items(S.interactions(spark, root)))


@query("cooccurrence", """SELECT source_item_id, neighbor_item_id, shared_users, source_users, neighbor_users
    FROM cv_edges""")
def _(spark, root):
    return covisit.covisit_edges(covisit.user_items(S.interactions(spark, root))).drop("score")


@query("collab_scores", "SELECT source_item_id, neighbor_item_id, score FROM cv_edges")
def _(spark, root):
    edges = covisit.covisit_edges(covisit.user_items(S.interactions(spark, root)))
    return edges.select("source_item_id", "neighbor_item_id", "score")


@query("pair_counts", """SELECT s AS item_id, t AS other_id, shared_users AS shared, x.users, y.users AS other_users,
    round(shared_users / sqrt(CAST(x.users * y.users AS DOUBLE)), 6) AS score
    FROM cv_pairs JOIN cv_n x ON x.item_id = s JOIN cv_n y ON y.item_id = t WHERE s < t""")
def _(spark, root):
    """Counts and scores of all pairs of titles, not of the published edges alone."""
    return covisit_view.pair_counts(covisit.user_items(S.interactions(spark, root)))


@query("stream_neighbors", "SELECT * FROM cv_edges")
def _(spark, root):
    """Edges of the maintained view after five batches of events."""

    def build():
        view = covisit_view.View(fresh_path(spark, "covisit-view"))
        events_of = materialize(S.interactions(spark, root), "view-events")
        for n in range(5):
            batch = events_of.filter(F.pmod(F.xxhash64("event_id"), F.lit(5)) == n)
            covisit_view.apply_batch(view, covisit.user_items(batch), n, compact_every=3)
        return view

    return shared("covisit-view", spark, root, build).edges(spark)


@query("collab_neighbors", "SELECT source_item_id, neighbor_item_id, score, 'collaborative' AS algorithm FROM cv_edges")
def _(spark, root):
    return covisit.collaborative_neighbors(S.interactions(spark, root))


@query("basket_neighbors", "SELECT * FROM bk_edges")
def _(spark, root):
    return covisit.covisit_edges(S.baskets(spark, root).distinct())


@query("basket_neighbors_large_users", "SELECT * FROM bk_edges")
def _(spark, root):
    return covisit.covisit_edges(S.baskets(spark, root).distinct(), pair_limit=60)


@query("content_scores", "SELECT * FROM it_top")
def _(spark, root):
    return content.content_scores(content.item_corpus(S.items(spark, root)), block_vectors=512)


@query("content_neighbors", "SELECT * FROM it_filled")
def _(spark, root):
    return content.content_neighbors(content.item_corpus(S.items(spark, root)))


@query("document_neighbors", "SELECT * FROM dc_filled")
def _(spark, root):
    return content.content_neighbors(S.documents(spark, root))


@query("item_neighbors", "SELECT * FROM neighbors")
def _(spark, root):
    return trained(spark, root).neighbors


@query("trending_scores", "SELECT region, item_id, CAST(weight AS DOUBLE) AS weight FROM trend_sums")
def _(spark, root):
    sums = trending.trending_scores(S.interactions(spark, root), as_of(spark, root))
    return sums.select("region", "item_id", F.col("weight").cast("double").alias("weight"))


@query("trending_items", "SELECT * FROM trending")
def _(spark, root):
    return trending.trending_items(S.interactions(spark, root), as_of(spark, root))


@query("training_summary", """SELECT algorithm || '_edges' AS output, count(*) AS rows FROM neighbors GROUP BY 1
    UNION ALL SELECT 'trending_rows', count(*) FROM trending""")
def _(spark, root):
    return T.summary(trained(spark, root)).select("output", "rows")


def daily_versions(spark, root):
    """The published records of a model version per day of events, as daily training would leave them."""

    def build():
        path = fresh_path(spark, "daily-models")
        days = S.table(spark, root, "events").groupBy(F.to_date("ts")).agg(F.max("ts").alias("created_at"))
        days.select(
            scoring.model_version_id(F.col("created_at")).alias("version"), F.lit(T.DESCRIPTION).alias("description"),
            "created_at",
        ).write.mode("append").parquet(f"{path}/versions")
        return path

    return T.versions(spark, shared("daily", spark, root, build))


@query("latest_version", "SELECT max_by(version, created_at) AS model_version FROM versions")
def _(spark, root):
    return P.latest_version(daily_versions(spark, root))


@query("training_runs", "SELECT count(*) AS runs FROM versions")
def _(spark, root):
    return daily_versions(spark, root).agg(F.count("*").alias("runs"))


# --- candidates and ranking ---------------------------------------------------------------------

def _found(spark, root):
    tables = serving(spark, root)
    return C.candidates(tables.users, tables.recent, tables.neighbors, tables.trending, tables.items)


@query("neighbor_candidates", "SELECT * FROM edge_scores")
def _(spark, root):
    return C.neighbor_scores(_found(spark, root))


@query("session_scores", "SELECT * FROM session")
def _(spark, root):
    return C.session_scores(recent(spark, root))


@query("trending_candidates", "SELECT user_id, item_id, score FROM offered WHERE source = 'trending'")
def _(spark, root):
    return _found(spark, root).filter("source = 'trending'").select("user_id", "item_id", "score")


@query("candidate_matrix", "SELECT * FROM matrix")
def _(spark, root):
    return P.merged_candidates(serving(spark, root)).drop("facts")


@query("normalized_candidates", "SELECT * FROM normal")
def _(spark, root):
    return C.normalized(P.merged_candidates(serving(spark, root))).drop("facts")


@query("candidate_counts", "SELECT user_id, count(*) AS candidates FROM matrix GROUP BY 1")
def _(spark, root):
    return P.merged_candidates(serving(spark, root)).groupBy("user_id").agg(F.count("*").alias("candidates"))


@query("mean_candidates", """SELECT round(avg(n), 6) AS mean_candidates
    FROM (SELECT user_id, count(*) AS n FROM matrix GROUP BY 1)""")
def _(spark, root):
    return rates.mean_candidates(P.merged_candidates(serving(spark, root)))


@query("unwatched_candidates", "SELECT user_id, item_id FROM unwatched")
def _(spark, root):
    tables = serving(spark, root)
    return R.unwatched(P.merged_candidates(tables), tables.watched).select("user_id", "item_id")


@query("candidate_items", "SELECT user_id, item_id, title, genres, release_year FROM titled")
def _(spark, root):
    return profiled(spark, root).select("user_id", "item_id", "title", "genres", "release_year")


@query("region_guardrail", "SELECT user_id, item_id FROM in_region")
def _(spark, root):
    allowed = scoring.available_in(F.col("region"), F.col("available_regions"))
    return profiled(spark, root).filter(allowed).select("user_id", "item_id")


@query("maturity_guardrail", "SELECT user_id, item_id FROM allowed")
def _(spark, root):
    return R.pass_guardrails(profiled(spark, root)).select("user_id", "item_id")


@query("genre_bonus", "SELECT user_id, item_id, genre_bonus FROM bonus")
def _(spark, root):
    return P.scored_candidates(serving(spark, root)).select("user_id", "item_id", "genre_bonus")


@query("blended_scores", "SELECT user_id, item_id, blend FROM scored")
def _(spark, root):
    return P.scored_candidates(serving(spark, root)).select("user_id", "item_id", "blend")


@query("reasons", "SELECT user_id, item_id, reason FROM reasoned")
def _(spark, root):
    return P.scored_candidates(serving(spark, root)).select("user_id", "item_id", "reason")


@query("diversity_cap", "SELECT user_id, item_id, lead_genre FROM capped")
def _(spark, root):
    return R.diverse(P.scored_candidates(serving(spark, root))).select("user_id", "item_id", "lead_genre")


@query("recommend_all", "SELECT * FROM served")
def _(spark, root):
    return P.recommend(serving(spark, root)).withColumn("position", F.col("position").cast("long"))


@query("recommend_one", """SELECT * FROM served WHERE user_id = (SELECT user_id FROM inter
    ORDER BY event_ts DESC, event_id DESC LIMIT 1)""")
def _(spark, root):
    """The user of the newest event, as a single request would ask."""
    return requests(spark, root).recommend(newest_user(spark, root)).withColumn("position", F.col("position").cast("long"))


@query("recommend_one_unstored", """SELECT * FROM served WHERE user_id = (SELECT user_id FROM inter
    ORDER BY event_ts DESC, event_id DESC LIMIT 1)""")
def _(spark, root):
    """The same from the whole tables, with the user as a filter."""
    user = newest_user(spark, root)
    return P.recommend(serving(spark, root).only_user(user)).withColumn("position", F.col("position").cast("long"))


@query("recommend_nested")
def _(spark, root):
    return P.recommend_nested(serving_published(spark, root))


@query("served_documents", """SELECT u.user_id, 'home' AS context,
    (SELECT 'hybrid-' || strftime(max(ts), '%Y%m%d%H%M%S') FROM events) AS model_version,
    coalesce((SELECT string_agg(item_id, ',' ORDER BY position) FROM recent r WHERE r.user_id = u.user_id
        AND position <= 10), '') AS recent_items, coalesce(string_agg(s.item_id || ':' || s.reason, ',' ORDER BY s.position), '')
    AS recommendations FROM users u LEFT JOIN served s ON s.user_id = u.user_id GROUP BY u.user_id""")
def _(spark, root):
    """The nested documents, flattened to strings."""
    one = F.transform("recommendations", lambda r: F.concat(r["item_id"], F.lit(":"), r["reason"]))
    return P.recommend_nested(serving_published(spark, root)).select(
        "user_id", "context", "model_version", F.array_join("recent_items", ",").alias("recent_items"),
        F.array_join(one, ",").alias("recommendations"),
    )


@query("unknown_users", "SELECT 's' || CAST(s_suppkey AS VARCHAR) AS user_id FROM supplier")
def _(spark, root):
    """Requests come from users and from suppliers, who are no users."""
    users = S.users(spark, root).select("user_id")
    outsiders = S.table(spark, root, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("user_id"))
    return P.unknown_users(users.unionByName(outsiders), users)


# --- operational aggregates ---------------------------------------------------------------------

PER_MINUTE = "SELECT time_bucket(INTERVAL '1 minute', {ts}, TIMESTAMP '1970-01-01') AS window_start, {by}count(*) AS n FROM {t} GROUP BY ALL"


@query("requests_per_minute", PER_MINUTE.format(ts="ts", by="", t="events"))
def _(spark, root):
    """The event table read as a serving log."""
    return rates.per_window(S.table(spark, root, "events"), "ts")


@query("requests_per_minute_by_context", PER_MINUTE.format(ts="ts", by="event_type AS context, ", t="events"))
def _(spark, root):
    """The event table read as a serving log, its type as the context of the request."""
    log = S.table(spark, root, "events").withColumnRenamed("event_type", "context")
    return rates.per_window(log, "ts", by=("context",))


@query("events_per_minute", PER_MINUTE.format(ts="event_ts", by="event_type, ", t="inter"))
def _(spark, root):
    return rates.per_window(S.interactions(spark, root), "event_ts", by=("event_type",))


@query("consumed_per_minute", PER_MINUTE.format(ts="event_ts", by="event_type, ", t="inter"))
def _(spark, root):
    fresh = events.first_arrivals(_sent_twice(spark, root), "arrival")
    return rates.per_window(fresh, "event_ts", by=("event_type",))


@query("consumed_by_type", "SELECT event_type, count(*) AS n FROM inter GROUP BY 1")
def _(spark, root):
    fresh = events.first_arrivals(_sent_twice(spark, root), "arrival")
    return fresh.groupBy("event_type").agg(F.count("*").alias("n"))


def _latency_sql() -> str:
    bounds = rates.LATENCY_BUCKETS
    values = ", ".join(f"({i}, {bounds[i - 1] if i else 0.0}::DOUBLE, {bound}::DOUBLE)" for i, bound in enumerate(bounds))
    return f"""SELECT window_start, round(coalesce(min_by(value, i) FILTER (reached >= rank), {bounds[-1]}::DOUBLE), 6)
        AS latency FROM (SELECT window_start, i, reached, 0.95::DOUBLE * n AS rank,
            low + (high - low) * (0.95::DOUBLE * n - below) / (reached - below) AS value
          FROM (SELECT window_start, i, low, high, count(*) AS n, count(*) FILTER (seconds <= high) AS reached,
                  count(*) FILTER (i > 0 AND seconds <= low) AS below
                FROM (SELECT time_bucket(INTERVAL '5 minutes', ts, TIMESTAMP '1970-01-01') AS window_start,
                          value / 100::DOUBLE AS seconds FROM events), (VALUES {values}) b(i, low, high)
                GROUP BY window_start, i, low, high)) GROUP BY window_start"""


@query("latency_p95", _latency_sql())
def _(spark, root):
    """The event table read as a serving log, a hundredth of ``value`` as the latency in seconds."""
    log = S.table(spark, root, "events").select("ts", (F.col("value") / F.lit(100.0)).alias("seconds"))
    return rates.latency_quantile(log, "ts", "seconds")


@query("active_users", """SELECT time_bucket(INTERVAL '1 hour', event_ts, TIMESTAMP '1970-01-01') AS window_start,
    count(DISTINCT user_id) AS users FROM inter GROUP BY 1""")
def _(spark, root):
    return rates.active_users(S.interactions(spark, root), "event_ts")


# --- streaming ----------------------------------------------------------------------------------

def _message_files(spark, root, name, rows):
    path = fresh_path(spark, name)
    rows.select("value").repartition(6).write.text(path)
    return path


def ingested(spark, root) -> str:
    """Output root of one ingestion run in which every event is delivered twice, in shuffled order."""

    def build():
        # One shuffle deals and mixes both copies; the files of a batch are as many as all cores write at once.
        per_batch = max(3, -(-spark.sparkContext.defaultParallelism // 2))
        sent = events.encode(S.interactions(spark, root)).select("value", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
        mixed = F.xxhash64("value", "copy")
        files = fresh_path(spark, "messages")
        sent.repartition(2 * per_batch, mixed).sortWithinPartitions(mixed).select("value").write.text(files)
        out = fresh_path(spark, "ingest")
        messages = I.read_files(spark, files, files_per_batch=per_batch)
        I.finish(I.ingest(spark, messages, S.items(spark, root), out, trigger={"availableNow": True}))
        return out

    return shared("ingested", spark, root, build)


def _stream_facts(spark, root):
    return I.read_facts(spark, ingested(spark, root)).select(*events.MESSAGE_FIELDS)


query("stream_ingest", INTER)(_stream_facts)


@query("stream_dedup", "SELECT event_id, count(*) AS n FROM inter GROUP BY 1")
def _(spark, root):
    return _stream_facts(spark, root).groupBy("event_id").agg(F.count("*").alias("n"))


@query("stream_archive", """SELECT strftime(event_ts, '%Y%m%d%H') AS hour, count(*) AS n FROM inter GROUP BY 1""")
def _(spark, root):
    out = ingested(spark, root)
    start, end = last_event(spark, root) - timedelta(days=3650), last_event(spark, root) + timedelta(hours=1)
    back = archive.replay(spark, I.Paths(out).archive, start, end)
    return back.groupBy(F.concat(*archive.HOUR_PARTS).alias("hour")).agg(F.count("*").alias("n"))


@query("stream_recent", "SELECT * FROM recent WHERE position <= 20")
def _(spark, root):
    rows = I.read_feature(spark, ingested(spark, root), "recent")
    return rows.withColumn("position", F.col("position").cast("long"))


@query("stream_watched", "SELECT * FROM watched")
def _(spark, root):
    return I.read_feature(spark, ingested(spark, root), "watched")


@query("stream_genre_affinity", "SELECT user_id, genre, CAST(affinity AS DOUBLE) AS affinity FROM affinity")
def _(spark, root):
    rows = I.read_feature(spark, ingested(spark, root), "affinity")
    return rows.withColumn("affinity", F.col("affinity").cast("double"))


@query("stream_popularity", POPULARITY)
def _(spark, root):
    rows = I.read_feature(spark, ingested(spark, root), "popularity")
    return rows.withColumn("popularity", F.col("popularity").cast("double"))


@query("stream_consumed", "SELECT event_type, count(*) AS n FROM inter GROUP BY 1")
def _(spark, root):
    return I.read_feature(spark, ingested(spark, root), "consumed")


@query("stream_trending", "SELECT * FROM trending")
def _(spark, root):
    return I.read_trending(spark, ingested(spark, root))


@query("stream_events_per_minute", PER_MINUTE.format(ts="event_ts", by="event_type, ", t="inter"))
def _(spark, root):
    files = _message_files(spark, root, "messages", events.encode(S.interactions(spark, root)))
    out = fresh_path(spark, "rates")
    arriving = events.usable(events.decode(I.read_files(spark, files, files_per_batch=2)))
    streaming_rates.count_per_minute(arriving, out, {"availableNow": True}, lateness="400 days").awaitTermination()
    return streaming_rates.read_counts(spark, out)
