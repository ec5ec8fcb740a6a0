"""Words of a text as all operators here count them, and small helpers that several of them share."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of characters other than space, tab, line feed, vertical tab, form feed and
# carriage return. ``bytes.split()`` cuts UTF-8 at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Rows of one Arrow batch between the JVM and Python; texts may be long, so it is far below Spark's default.
BATCH_ROWS = 1000


def lowered(text: Column) -> Column:
    """A-Z to lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def text_digest(text: Column) -> Column:
    """16 bytes that tell texts apart; a null text counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


@contextlib.contextmanager
def merge_joins(spark: SparkSession) -> Iterator[None]:
    """Joins planned inside send no table to every task.

    For steps of many rounds, each of which would build its broadcasts in the driver, and for exploded rows, whose size
    Spark guesses from the arrays they come from. The session's settings come back at the end, so what is read lazily
    later is planned by them.
    """
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "-1")
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def small_batches(df: DataFrame) -> None:
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def sampled(df: DataFrame, key: str, bound: int, *ties: str) -> DataFrame:
    """At most ``bound`` rows, those with the smallest hash of their key, so the same rows at every run.

    A large table is first thinned by the hash itself to about four times the bound, so what the tasks send grows with
    the bound and not with their number.
    """
    n = df.count()
    mark = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    if n > 4 * bound:
        df = df.filter(mark < int((1 << 40) * 4 * bound / n))
    return df.orderBy(mark, key, *ties).limit(bound)


def batches(schema: pa.Schema, rows: Iterator[tuple], size: int = BATCH_ROWS, most_bytes: int = 8 << 20,
            weigh=None) -> Iterator[pa.RecordBatch]:
    """Arrow batches from row tuples. ``weigh`` gives a row's bytes, so that large rows make small batches."""
    held: list[tuple] = []
    total = 0
    for row in rows:
        held.append(row)
        total += weigh(row) if weigh else 0
        if len(held) >= size or total >= most_bytes:
            yield _batch(schema, held)
            held, total = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(columns, schema.types, strict=True)], schema=schema
    )
