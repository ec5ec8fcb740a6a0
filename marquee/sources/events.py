"""Event messages: decoding with quarantine, encoding, de-duplication and the fact table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schema import EVENT_MESSAGE, INTERACTIONS

# Date, time and optional fraction and offset; a date or a time alone is no event time.
ISO_STAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?$"
REQUIRED = ("event_id", "user_id", "item_id", "event_type", "region", "device_type", "event_ts")
MESSAGE_FIELDS = INTERACTIONS.fieldNames()


def encode(events: DataFrame) -> DataFrame:
    """Keyed messages: the user is the key, so one user's events stay in one topic partition."""
    body = [F.col(name) for name in MESSAGE_FIELDS if name != "event_ts"]
    stamp = F.date_format(F.col("event_ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("event_ts")
    return events.select(F.col("user_id").alias("key"), F.to_json(F.struct(*body, stamp)).alias("value"))


def _number(name: str) -> Column:
    """A missing, null or empty number is 0; text that is no finite number gives NULL."""
    raw = F.trim(F.col(name))
    value = raw.try_cast("double")
    finite = F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)
    return F.when(raw.isNull() | (raw == ""), F.lit(0.0)).otherwise(finite)


def decode(messages: DataFrame) -> DataFrame:
    """Parse JSON ``value`` into typed columns plus ``problem``, NULL for a usable event.

    ``event_ts`` is a TIMESTAMP, as event time must be; ``value`` is kept for the archive.
    """
    schema = T.StructType([*EVENT_MESSAGE.fields, T.StructField("_corrupt", T.StringType())])
    text = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    # The generator keeps the parse a step of its own, so it runs once per message and not once per
    # column that is read from it.
    parsed = messages.select(
        text.alias("value"), F.inline(F.array(F.from_json(text, schema, options)))
    ).select(
        "value", "event_id", "user_id", "item_id", "event_type",
        _number("watch_seconds").try_cast("int").alias("watch_seconds"),
        _number("completion_pct").alias("completion_pct"),
        "region", "device_type",
        F.when(F.col("event_ts").rlike(ISO_STAMP), F.try_to_timestamp("event_ts")).alias("event_ts"),
        F.col("_corrupt").isNotNull().alias("corrupt"),
        F.col("event_ts").alias("stamp"),
    )
    problem = F.when(F.col("corrupt") | F.col("value").isNull(), "malformed")
    for name in REQUIRED:
        given = F.col("stamp" if name == "event_ts" else name)
        problem = problem.when(given.isNull() | (F.trim(given) == ""), f"missing {name}")
    for name in ("event_ts", "watch_seconds", "completion_pct"):
        problem = problem.when(F.col(name).isNull(), f"bad {name}")
    return parsed.withColumn("problem", problem).drop("corrupt", "stamp")


def usable(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("problem").isNull()).drop("problem")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("problem").isNotNull()).select("value", "problem")


def first_arrivals(events: DataFrame, arrival: str | None = None) -> DataFrame:
    """One row per event id, the first to arrive.

    The rank limit runs before the shuffle too, so a flood of copies of one id is reduced to one row
    per task where it is read.
    """
    order = [F.col(arrival)] if arrival else [F.col(name) for name in ("event_ts", "user_id", "item_id")]
    window = Window.partitionBy("event_id").orderBy(*order)
    return events.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def unseen(events: DataFrame, facts: DataFrame, same_day: bool = False) -> DataFrame:
    """Events whose id is not among the stored facts.

    ``same_day`` reads only the ``event_date`` partitions that the batch touches; it is exact when a
    redelivered message keeps its event time.
    """
    stored = facts
    if same_day:
        days = events.select(F.to_date("event_ts").alias("event_date")).distinct()
        stored = facts.join(days, "event_date", "left_semi")
    return events.join(stored.select("event_id"), "event_id", "left_anti")


def append_facts(events: DataFrame, path: str, arrival: str | None = None, same_day: bool = False) -> None:
    """Batch load into the fact table: insert each event id once, ignore ids already stored.

    ``ingestion_ts`` is the time of the load, for the analysis of late arrivals and replays.
    """
    fresh = first_arrivals(events, arrival)
    if arrival:
        fresh = fresh.drop(arrival)
    try:
        stored = events.sparkSession.read.parquet(path)
    except AnalysisException:
        stored = None
    if stored is not None:
        fresh = unseen(fresh, stored, same_day)
    (
        fresh.withColumns({"ingestion_ts": F.localtimestamp(), "event_date": F.to_date("event_ts")})
        .hint("rebalance", "event_date")
        .write.mode("append").partitionBy("event_date").parquet(path)
    )
