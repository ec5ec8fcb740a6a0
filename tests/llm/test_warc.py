import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from marquee.llm import warc

SCHEMA = "page_id long, url string, html string, data string, last boolean"


def expected(rows, least=0):
    first = {}
    for key, _, html, *_ in rows:
        if key is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(first.get(html or "", key), key)
    out = []
    for key, _, html, *_ in rows:
        raw = (html or "").encode()
        refers = first.get(html or "", key)
        other = refers != key
        out.append((key, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if other else "response", refers if other else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


ROWS = [
    (1, "http://a/", "x" * 50), (2, "http://b/", "x" * 50), (0, None, "x" * 50), (3, "http://c/\r\nX: y", None),
    (4, "u", ""), (5, "u", "line\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (6, "u", "ends\r\n"), (7, "u", "ends\r"),
    (8, "u", "\r\n\r\n"), (9, "u", "ends\r\n\r"), (10, "ü", "é😀" * 30), (None, "u", "no id"), (None, None, "x" * 50),
    (11, "u", "twice"), (11, "u", "twice"), (12, "u", "twice"), (13, "u", "\n"), (14, "u", "﻿mark"), (15, "u", "\x00"),
]


@pytest.mark.parametrize("chunk", [7, warc.CHUNK_BYTES])
def test_round_trip(spark, chunk):
    rows = [(*r, "clash", True) for r in ROWS]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(warc.round_trip(pages, chunk)) == expected(rows)


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(*r, None, None) for r in ROWS], SCHEMA)
    assert rows_of(warc.round_trip(pages, least_bytes=20)) == expected(ROWS, 20)


def test_long_payload_is_segmented(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "long text " * 400_000, None, None)], SCHEMA)
    warc.write_archives(pages, str(tmp_path / "w"), 1 << 16)
    back = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert [(r.payload_bytes, r.segments) for r in back] == [(4_000_000, 62)]
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "w").glob("*.gz"))
    assert raw.count(b"WARC-Type: continuation") == 61 and b"WARC-Segment-Total-Length: 4000000" in raw


def test_damage_is_found(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "some payload", None, None)], SCHEMA).coalesce(1)
    warc.write_archives(pages, str(tmp_path / "w"))
    part = next(p for p in Path(tmp_path / "w").glob("*.gz") if b"some payload" in gzip.decompress(p.read_bytes()))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.txt.gz").write_bytes(gzip.compress(gzip.decompress(part.read_bytes()).replace(b"some payload", b"sOme payload")))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archives(spark, str(tmp_path / "bad")).collect()


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
