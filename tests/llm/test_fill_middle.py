"""Fill-in-middle against a row-by-row version."""

import hashlib
import random
import re

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marquee.llm import fill_middle

ROWS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])


def plain(key, text, rate=100, spm_rate=50):
    """(n, form, prefix chars, middle chars, output) of one row."""
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def _check(spark, rows, **options):
    made = fill_middle.restored(fill_middle.transformed(spark.createDataFrame(rows, ROWS).repartition(3), **options)).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made), key=repr)
    assert got == sorted(((i, *plain(i, t, **options)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.restored) for r in made), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)


def test_equals_plain_version(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab\n<SPM>é😀\r\x00") for _ in range(rng.randrange(40)))) for i in range(600)]
    _check(spark, rows)
    _check(spark, rows, rate=40, spm_rate=90)


def test_odd_texts(spark):
    texts = [None, "", "\n", "\n\n", "a", "a\n", "<P>x\n", "x<", "<S", "<M>", "\r\n", "end <"]
    _check(spark, [(i, t) for i, t in enumerate(texts)] + [(None, "a\nb"), (None, "a\nb"), (-5, "c\nd\ne"), (-5, "c\nd\ne")])


def test_very_long_text_among_short_ones(spark, monkeypatch):
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 1000)
    long = "word " * 7 + "\n"
    _check(spark, [(1, "a\nb\n"), (2, long * 20_000), (3, "x" * 3_000_000), (4, "c")])


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], ROWS)
    assert fill_middle.restored(fill_middle.transformed(empty)).count() == 0
    rows = spark.createDataFrame([(1, "a\nb\nc")], ROWS)
    for name in ("key", "n", "form", "output", "restored", "draw_1", "prefix_chars"):
        rows = rows.withColumn(name, F.lit("other"))
    (got,) = fill_middle.restored(fill_middle.transformed(rows)).collect()
    assert (got.n, got.form, got.prefix_chars, got.middle_chars, got.output) == plain(1, "a\nb\nc")


def test_no_shuffle(spark):
    rows = spark.createDataFrame([(1, "a")], ROWS)
    assert "Exchange" not in fill_middle.transformed(rows)._jdf.queryExecution().executedPlan().toString()
