"""Schemas of the entity tables, the event message and the published tables."""

from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("preferred_language", T.StringType()),
    T.StructField("maturity_rating", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

ITEMS = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("item_type", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("actors", T.StringType()),
    T.StructField("director", T.StringType()),
    T.StructField("synopsis", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("maturity_rating", T.StringType()),
    T.StructField("available_regions", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

# The JSON message. Numbers are read as text so that a bad number quarantines one
# message instead of failing the parse of its neighbours.
EVENT_MESSAGE = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "event_id", "user_id", "item_id", "event_type", "watch_seconds",
        "completion_pct", "region", "device_type", "event_ts",
    )
])

INTERACTIONS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("watch_seconds", T.IntegerType()),
    T.StructField("completion_pct", T.DoubleType()),
    T.StructField("region", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("event_ts", T.TimestampNTZType()),
])

# Facts as the stream stores them; event time is a TIMESTAMP there, as watermarks need it.
STORED_FACTS = T.StructType([
    *INTERACTIONS.fields[:-1],
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("ingestion_ts", T.TimestampNTZType()),
    T.StructField("event_date", T.DateType()),
])

NEIGHBORS = T.StructType([
    T.StructField("source_item_id", T.StringType()),
    T.StructField("neighbor_item_id", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("algorithm", T.StringType()),
])

TRENDING = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

MODEL_VERSIONS = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])
