from datetime import datetime

from pyspark.sql import functions as F

from marquee import schema
from marquee.operators import trending
from marquee.sources import archive, events

GOOD = '"event_id":"1","user_id":"u","item_id":"m","event_type":"click","region":"UK","device_type":"tv"'


def decode(spark, *messages):
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    return [row.asDict() for row in events.decode(df).collect()]


def test_times_with_z_and_offsets(spark):
    rows = decode(
        spark,
        "{" + GOOD + ',"event_ts":"2026-03-25T08:39:26Z"}',
        "{" + GOOD + ',"event_ts":"2026-03-25T10:39:26.5+02:00"}',
    )
    assert [row["problem"] for row in rows] == [None, None]
    assert rows[0]["event_ts"] == datetime(2026, 3, 25, 8, 39, 26)
    assert rows[1]["event_ts"] == datetime(2026, 3, 25, 8, 39, 26, 500000)


def test_missing_and_empty_numbers_are_zero(spark):
    time = ',"event_ts":"2026-03-25T08:39:26Z"'
    rows = decode(
        spark,
        "{" + GOOD + time + "}",
        "{" + GOOD + time + ',"watch_seconds":null,"completion_pct":""}',
        "{" + GOOD + time + ',"watch_seconds":31.0,"completion_pct":12.5}',
    )
    assert [(row["watch_seconds"], row["completion_pct"]) for row in rows] == [(0, 0.0), (0, 0.0), (31, 12.5)]


def test_unusable_messages_are_named(spark):
    time = ',"event_ts":"2026-03-25T08:39:26Z"}'
    rows = decode(
        spark,
        '{"event_id":"1","user',
        "{" + GOOD.replace('"region":"UK",', "") + time,
        "{" + GOOD + "}",
        "{" + GOOD + ',"event_ts":"soon"}',
        "{" + GOOD + ',"watch_seconds":"many"' + time,
        None,
    )
    assert [row["problem"] for row in rows] == [
        "malformed", "missing region", "missing event_ts", "bad event_ts", "bad watch_seconds", "malformed",
    ]


def fact_rows(spark, *ids, device="web", day=1):
    rows = [
        (i, "u", "m", "click", 1, 1.0, "UK", device, datetime(2026, 1, day, 12)) for i in ids
    ]
    return spark.createDataFrame(rows, schema.INTERACTIONS)


def test_facts_keep_the_first_of_every_id(spark, tmp_path):
    path = str(tmp_path / "facts")
    events.append_facts(fact_rows(spark, "1", "2"), path)
    events.append_facts(fact_rows(spark, "2", "3", "3", device="tv"), path)
    events.append_facts(fact_rows(spark, "3", device="late", day=2), path)
    got = {(r["event_id"], r["device_type"]) for r in spark.read.parquet(path).collect()}
    assert got == {("1", "web"), ("2", "web"), ("3", "tv")}
    assert spark.read.parquet(path).count() == 3


def test_same_day_load_reads_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "facts")
    events.append_facts(fact_rows(spark, "1"), path)
    events.append_facts(fact_rows(spark, "1", "2"), path, same_day=True)
    assert {r["event_id"] for r in spark.read.parquet(path).collect()} == {"1", "2"}
    assert spark.read.parquet(path).count() == 2


def test_archive_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = [(str(i), "u", f'{{"n":{i}}}', datetime(2026, 1, 1 + i, 3 + i)) for i in range(3)]
    df = spark.createDataFrame(rows, "event_id string, user_id string, value string, event_ts timestamp")
    archive.write_archive(df, path)
    archive.write_archive(df, path)
    back = archive.replay(spark, path, datetime(2026, 1, 2), datetime(2026, 1, 3, 5))
    assert [(r["event_id"], r["hour"]) for r in back.collect()] == [("1", "04")]
    assert archive.replay(spark, path, datetime(2025, 1, 1), datetime(2027, 1, 1)).count() == 3
    assert archive.replay(spark, path, datetime(2025, 1, 1), datetime(2025, 2, 1)).count() == 0
    assert all("hour=04" in name for name in back.inputFiles())


def test_replay_lists_only_the_hours_asked_for(spark, tmp_path, monkeypatch):
    listed = []
    path = str(tmp_path / "archive")
    stamps = [datetime(2026, month, day, hour) for month in (1, 2) for day in (1, 2, 3) for hour in (4, 5)]
    rows = [(str(n), "u", "{}", stamp) for n, stamp in enumerate(stamps)]
    df = spark.createDataFrame(rows, "event_id string, user_id string, value string, event_ts timestamp_ntz")
    for batch in (0, 1, 1):  # a batch that is written again replaces itself
        archive.write_archive(df, path, batch)
    assert archive.read_archive(spark, path).count() == 24
    real = archive.children
    monkeypatch.setattr(archive, "children", lambda s, p, key: listed.append(p) or real(s, p, key))
    found = archive.hour_folders(spark, path, datetime(2026, 2, 2, 5), datetime(2026, 2, 3, 5))
    assert [f.removeprefix(path) for f in found] == [
        "/year=2026/month=02/day=02/hour=05", "/year=2026/month=02/day=03/hour=04"
    ]
    assert not any("month=01" in p or "day=01" in p for p in listed)
    assert archive.replay(spark, path, datetime(2026, 2, 2, 5), datetime(2026, 2, 3, 5)).count() == 2


def test_numbers_and_times_are_strict(spark):
    time = ',"event_ts":"2026-03-25T08:39:26Z"}'
    rows = decode(
        spark,
        "{" + GOOD + ',"completion_pct":1e12' + time,
        "{" + GOOD + ',"completion_pct":"NaN"' + time,
        "{" + GOOD + ',"completion_pct":"Infinity"' + time,
        "{" + GOOD + ',"event_ts":"12:30"}',
        "{" + GOOD + ',"event_ts":"2026"}',
        "{" + GOOD + ',"event_ts":"2026-03-25"}',
        "{" + GOOD + ',"event_ts":"2026-03-25 08:39"}',
        "{" + GOOD.replace('"user_id":"u"', '"user_id":" "') + time,
    )
    assert [row["problem"] for row in rows] == [
        None, "bad completion_pct", "bad completion_pct", "bad event_ts", "bad event_ts", "bad event_ts", None, "missing user_id",
    ]


def test_trending_takes_every_finite_percentage(spark):
    stamp = datetime(2026, 1, 1, 12)
    values = [1e12, -1e300, 1e300, float("nan"), 50.0, None]
    rows = [(str(n), "u", f"m{n}", "click", 1, v, "UK", "web", stamp) for n, v in enumerate(values)]
    df = spark.createDataFrame(rows, schema.INTERACTIONS)
    got = {r["item_id"]: r["score"] for r in trending.trending_items(df, F.lit(stamp)).collect()}
    assert got["m0"] == 0.5 + 1e10 and got["m2"] == 0.5 + 1e13 and got["m1"] == 0.5 - 1e13
    assert got["m3"] == 0.5 and got["m4"] == 1.0


def test_flood_of_copies_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 2000, "same").alias("event_id"), F.col("id").alias("arrival"))
    first = events.first_arrivals(df, "arrival")
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [row["arrival"] for row in first.collect()] == [0]
