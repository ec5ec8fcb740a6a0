"""Fill-in-middle transformation: the lines of a text are cut into prefix, middle and suffix and put in another order.

Everything between the JVM's batches is a pipeline of Arrow kernels. The texts of a slice are split at line feeds into
a list array; the list is flattened with the index of its text, and every unit gets its ordinal within the text. A unit
belongs to the prefix, the middle or the suffix by its ordinal alone, so three filters and the counts of each text
rebuild three list arrays, which are joined to strings, and the pieces are put together by form. No text is handled by
itself in Python.

Plan: one pass over the table, no shuffle and no state between rows. The four draws come from a digest of the key and
are computed by Spark, so a row is transformed alike in every run and wherever it stands. A batch is handled in slices
of at most ``SLICE_BYTES`` of text; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SEED = 7
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE = 100  # percent of the texts that are transformed
SPM_RATE = 50  # percent of the transformed ones with the suffix first
SLICE_BYTES = 8 << 20

_DRAWS = ("draw_1", "draw_2", "draw_3", "draw_4")
_OUT = pa.schema([
    ("key", pa.string()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
    ("middle_chars", pa.int64()), ("output", pa.string()),
])


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch cut where the bytes of a text column pass ``SLICE_BYTES``."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0)
    total = pc.cumulative_sum(pc.cast(sizes, pa.int64()))
    group = pc.divide(pc.subtract(total, sizes), SLICE_BYTES)
    at = 0
    while at < batch.num_rows:
        width = pc.sum(pc.equal(group, group[at])).as_py()
        yield batch.slice(at, width)
        at += width


def _modulo(value: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(value, pc.multiply(pc.divide(value, by), by))


def _offsets(counts: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)])


def _marked(*pieces) -> pa.Array:
    """Arrays and constants put together row by row."""
    return pc.binary_join_element_wise(*[pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in pieces], pa.scalar("", pa.large_string()))


def units(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(unit, index of its text, ordinal in the text) of every line of every text, the line feed included."""
    parts = pc.split_pattern(texts, "\n")
    flat, parent = pc.list_flatten(parts), pc.cast(pc.list_parent_indices(parts), pa.int64())
    count = pc.cast(pc.list_value_length(parts), pa.int64())
    start = _offsets(count)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), start.take(parent))
    last = pc.equal(ordinal, pc.subtract(count.take(parent), 1))
    unit = pc.if_else(last, flat, _marked(flat, "\n"))
    real = pc.invert(pc.and_(last, pc.equal(pc.binary_length(flat), 0)))
    return unit.filter(real), parent.filter(real), ordinal.filter(real)


def _joined(unit: pa.Array, chosen: pa.Array, counts: pa.Array) -> pa.Array:
    """One string per text from the chosen units; ``counts`` says how many of them each text has."""
    lists = pa.LargeListArray.from_arrays(_offsets(counts), unit.filter(chosen))
    return pc.binary_join(lists, pa.scalar("", pa.large_string()))


def transform_slice(key: pa.Array, text: pa.Array, draws: list[pa.Array], rate: int, spm_rate: int) -> pa.RecordBatch:
    texts = pc.fill_null(pc.cast(text, pa.large_string()), "")
    unit, parent, ordinal = units(texts)
    total = pc.add(pc.count_substring(texts, "\n"), pc.cast(pc.invert(pc.or_(pc.ends_with(texts, "\n"), pc.equal(texts, ""))), pa.int32()))
    n = pc.cast(total, pa.int64())
    cuts = [_modulo(draw, pc.add(n, 1)) for draw in draws[:2]]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)

    in_prefix, in_rest = pc.less(ordinal, low.take(parent)), pc.greater_equal(ordinal, high.take(parent))
    prefix = _joined(unit, in_prefix, low)
    middle = _joined(unit, pc.invert(pc.or_(in_prefix, in_rest)), pc.subtract(high, low))
    suffix = _joined(unit, in_rest, pc.subtract(n, high))

    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(pc.equal(texts, ""), pc.greater_equal(_modulo(draws[2], hundred), rate))
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    spm = pc.less(_modulo(draws[3], hundred), spm_rate)
    moved = pc.if_else(
        spm, _marked(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle), _marked(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    )
    length = lambda piece: pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(piece), pa.int64()))
    return pa.RecordBatch.from_arrays([
        key, n, pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")), length(prefix), length(middle),
        pc.cast(pc.if_else(plain, texts, moved), pa.string()),
    ], schema=_OUT)


def restore_slice(form: pa.Array, output: pa.Array) -> pa.Array:
    """The texts that outputs were made of. A text that holds a mark is plain, so each mark stands once in the others."""
    output = pc.cast(output, pa.large_string())

    def pieces(wanted: str, first: str, second: str) -> tuple[pa.Array, pa.Array, pa.Array]:
        blank = pa.scalar(first + second + MIDDLE, pa.large_string())
        body = pc.utf8_slice_codeunits(pc.if_else(pc.equal(form, wanted), output, blank), len(first))
        halves = pc.split_pattern(body, second)
        tail = pc.split_pattern(pc.list_element(halves, 1), MIDDLE)
        return pc.list_element(halves, 0), pc.list_element(tail, 0), pc.list_element(tail, 1)

    prefix, suffix, middle = pieces("psm", PREFIX, SUFFIX)
    psm = _marked(prefix, middle, suffix)
    suffix, prefix, middle = pieces("spm", SUFFIX, PREFIX)
    spm = _marked(prefix, middle, suffix)
    return pc.cast(pc.if_else(pc.equal(form, "plain"), output, pc.if_else(pc.equal(form, "spm"), spm, psm)), pa.string())


def transformed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE,
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row; other columns are ignored, whatever their names.

    ``n`` counts the units, ``form`` is plain, psm or spm, the two lengths are code points and null for plain. A null
    text counts as empty, an empty text is plain. A null key draws as the empty key. Rows that share a key share its
    draws; every row stands for itself. An empty table gives no rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(name) for i, name in enumerate(_DRAWS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "text"):
                yield transform_slice(part["key"], part["text"], [part[name] for name in _DRAWS], rate, spm_rate)

    made = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"), *draws).mapInArrow(
        run, "key string, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )
    return made.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)


def restored(made: DataFrame) -> DataFrame:
    """The rows of ``transformed`` with ``restored``, the text rebuilt from ``form`` and ``output`` alone."""
    schema = StructType([*made.schema.fields, StructField("restored", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "output"):
                columns = [*part.columns, restore_slice(part["form"], part["output"])]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "restored"])

    return made.mapInArrow(run, schema)
