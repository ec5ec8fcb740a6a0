import random
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marquee import schema
from marquee.operators import features
from marquee.plans import train
from marquee.session import exists, workspace
from marquee.sources import events
from marquee.streaming import ingest as I
from marquee.streaming import rates
from marquee.streaming.retrain import retrain, train_if_due

START = datetime(2026, 1, 1)
KINDS = ["impression", "click", "play_start", "watch_progress", "complete", "watchlist_add", "other"]


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        user = "hot" if i % 3 == 0 else f"u{rng.randint(1, 9)}"
        rows.append((
            str(i), user, f"m{rng.randint(0, 45):02d}", rng.choice(KINDS), rng.randint(0, 300),
            round(rng.random() * 100, 2), rng.choice(["UK", "ZA"]), "web",
            START + timedelta(seconds=rng.randint(0, 200_000), microseconds=i),
        ))
    return spark.createDataFrame(rows, schema.INTERACTIONS)


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        (f"m{i:02d}", f"title {i}", "movie", "drama, crime" if i % 2 else "food", "", "", f"text {i % 7}", "en", 2024,
         "PG", "GLOBAL", i % 5 != 0, None)
        for i in range(40)
    ]
    return spark.createDataFrame(rows, schema.ITEMS)


def deliver(spark, facts, folder, copies=2, bad=("{broken",)):
    """Every event twice, shuffled, over several files, with unusable messages in between."""
    messages = [r["value"] for r in events.encode(facts).select("value").collect()] * copies + list(bad)
    random.Random(3).shuffle(messages)
    folder.mkdir()
    for n in range(5):
        (folder / f"part{n}.txt").write_text("\n".join(messages[n::5]) + "\n")
    return str(folder)


@pytest.fixture(scope="module")
def root(spark, facts, items, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stream")
    source = deliver(spark, facts, folder / "in")
    out = str(folder / "out")
    messages = I.read_files(spark, source, files_per_batch=2)
    I.finish(I.ingest(spark, messages, items, out, trigger={"availableNow": True}))
    return out


def rows(df, *columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in df.collect())


def assert_features(spark, root, facts, items):
    summary = features.user_item_summary(facts, items)
    recent = features.recent_items(features.last_seen(summary), 20)
    columns = ("user_id", "item_id", "last_ts", "position")
    assert rows(I.read_feature(spark, root, "recent"), *columns) == rows(recent, *columns)
    columns = ("user_id", "item_id")
    assert rows(I.read_feature(spark, root, "watched"), *columns) == rows(features.watched_items(summary), *columns)
    columns = ("user_id", "genre", "affinity")
    assert rows(I.read_feature(spark, root, "affinity"), *columns) == rows(features.genre_affinity(summary, items), *columns)
    columns = ("region", "item_id", "popularity")
    assert rows(I.read_feature(spark, root, "popularity"), *columns) == rows(
        features.regional_popularity(facts, items), *columns
    )


def test_facts_equal_the_sent_events(spark, root, facts):
    got = I.read_facts(spark, root).select(*events.MESSAGE_FIELDS)
    assert rows(got, *events.MESSAGE_FIELDS) == rows(facts, *events.MESSAGE_FIELDS)
    assert spark.read.parquet(I.Paths(root).quarantine).collect()[0]["problem"] == "malformed"


def test_features_equal_the_batch_operators(spark, root, facts, items):
    assert_features(spark, root, facts, items)
    consumed = {r["event_type"]: r["n"] for r in I.read_feature(spark, root, "consumed").collect()}
    assert sum(consumed.values()) == 600


def test_a_repeated_batch_changes_nothing(spark, root, facts, items):
    paths = I.Paths(root)
    batch = spark.read.parquet(f"{paths.facts}/batch_id=1").drop("event_date", "ingestion_ts")
    again = spark.createDataFrame(batch.collect(), batch.schema)
    I._write_batch(items, paths)(again, 1)
    assert_features(spark, root, facts, items)
    assert I.read_facts(spark, root).count() == 600


def test_a_batch_gathers_days_where_the_stream_is_not_adaptive(spark, facts, items, tmp_path):
    name, paths = "spark.sql.adaptive.enabled", I.Paths(str(tmp_path))
    batch = facts.withColumn("event_ts", F.col("event_ts").cast("timestamp")).repartition(4)
    spark.conf.set(name, "false")  # as in the session of a stateful stream
    try:
        I._write_batch(items, paths)(batch, 0)
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.set(name, "true")
    days = list(Path(paths.facts, "batch_id=0").glob("event_date=*"))
    assert len(days) == 3 and all(len(list(day.glob("*.parquet"))) == 1 for day in days)
    assert_features(spark, str(tmp_path), facts, items)


def test_facts_carry_the_time_of_their_load(spark, root):
    facts = I.read_facts(spark, root)
    assert facts.filter("ingestion_ts IS NULL").count() == 0 and facts.schema["ingestion_ts"].dataType.simpleString() == "timestamp_ntz"


def test_batches_leave_no_intermediate_tables(spark, root):
    assert not exists(spark, f"{workspace(spark)}/{spark.sparkContext.applicationId}") or not [
        p for p in Path(workspace(spark), spark.sparkContext.applicationId).iterdir() if p.name.startswith("batch-")
    ]


def test_compaction_changes_nothing_and_retires_what_it_covers(spark, facts, items, tmp_path):
    source, out = deliver(spark, facts, tmp_path / "in"), str(tmp_path / "out")

    def run():
        I.finish(I.ingest(spark, I.read_files(spark, source, 2), items, out, trigger={"availableNow": True}))

    run()
    names = ("recent", "watched", "affinity", "popularity")
    for name in names:
        upto = I.compact(spark, out, name)
        assert upto == 2 and I.compact(spark, out, name) == upto
    assert I.compact_facts(spark, out) == 2
    assert_features(spark, out, facts, items)
    assert I.batches_after(spark, I.Paths(out).feature("recent"), None) == [0, 1, 2]  # kept for running readers
    (tmp_path / "in" / "more.txt").write_text('{"event_id": "x"}\n')
    run()
    for name in names:
        assert I.compact(spark, out, name) == 3
        folder = I.Paths(out).feature(name)
        assert I.batches_after(spark, folder, None) == [3] and I._bases(spark, folder) == [2, 3]
    assert I.compact_facts(spark, out) == 3
    assert I.batches_after(spark, I.Paths(out).facts, None) == [3] and I.last_batch(spark, out) == 3
    assert_features(spark, out, facts, items)
    assert rows(I.read_facts(spark, out), "event_id") == rows(facts, "event_id")


def test_restart_continues_after_new_messages(spark, facts, items, tmp_path):
    first, second = facts.filter("cast(event_id as int) < 300"), facts.filter("cast(event_id as int) >= 250")
    source, out = deliver(spark, first, tmp_path / "in"), str(tmp_path / "out")

    def run():
        I.finish(I.ingest(spark, I.read_files(spark, source), items, out, trigger={"availableNow": True}))

    run()
    late = [r["value"] for r in events.encode(second).select("value").collect()]
    (tmp_path / "in" / "late.txt").write_text("\n".join(late) + "\n")
    run()
    assert rows(I.read_facts(spark, out), "event_id") == rows(facts, "event_id")
    assert_features(spark, out, facts, items)


def test_bounded_dedup_drops_close_copies(spark, facts, items, tmp_path):
    source, out = deliver(spark, facts, tmp_path / "in"), str(tmp_path / "out")
    messages = I.read_files(spark, source)
    I.finish(I.ingest(spark, messages, items, out, trigger={"availableNow": True}, horizon="30 days"))
    assert I.read_facts(spark, out).count() == 600


def test_counts_per_minute(spark, facts, tmp_path):
    source, out = deliver(spark, facts, tmp_path / "in", copies=1), str(tmp_path / "out")
    arriving = events.usable(events.decode(I.read_files(spark, source, 2)))
    rates.count_per_minute(arriving, out, {"availableNow": True}, lateness="30 days").awaitTermination()
    minute = F.window("event_ts", "1 minute")["start"].alias("window_start")
    batch = facts.groupBy(minute, "event_type").agg(F.count("*").alias("n"))
    columns = ("window_start", "event_type", "n")
    assert rows(rates.read_counts(spark, out), *columns) == rows(batch, *columns)


def test_a_failed_training_run_is_tried_again_without_new_facts(spark, root, items, tmp_path):
    model = str(tmp_path / "model")
    assert train.read_published(spark, model).neighbors.count() == 0

    def broken():
        raise RuntimeError("catalog is away")

    with pytest.raises(RuntimeError):
        train_if_due(spark, broken, root, model)
    assert train.versions(spark, model).count() == 0
    before = set(Path(workspace(spark), spark.sparkContext.applicationId).glob("*"))
    clock = lambda: datetime(2026, 1, 3, 1)
    assert train_if_due(spark, lambda: items, root, model, clock) == "hybrid-20260103010000"
    assert train_if_due(spark, lambda: items, root, model, clock) is None  # no new facts
    assert set(Path(workspace(spark), spark.sparkContext.applicationId).glob("*")) == before
    published = train.read_published(spark, model)
    assert {r["algorithm"] for r in published.neighbors.select("algorithm").distinct().collect()} == {
        "collaborative", "content"
    }
    assert published.trending.count() > 0
    assert train.publish(published, model, clock()) == "hybrid-20260103010001"  # a set in use is not replaced


def test_retraining_goes_on_after_a_failure(spark, root, items, tmp_path):
    model, calls = str(tmp_path / "model"), []

    def catalog():
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("catalog is away")
        return items

    query = retrain(spark, catalog, root, model, {"processingTime": "1 second"}, clock=lambda: datetime(2026, 1, 3, 1))
    deadline = time.time() + 120
    while train.versions(spark, model).count() == 0 and time.time() < deadline:
        time.sleep(1)
    query.stop()
    assert len(calls) >= 2 and [r["version"] for r in train.versions(spark, model).collect()] == ["hybrid-20260103010000"]
