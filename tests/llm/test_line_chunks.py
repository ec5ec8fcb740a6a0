import random

from marquee.llm import line_chunks
from tests.llm import plain

SCHEMA = "doc_id long, text string, lines string, removed_lines string, at int, _cuts int"


def _rows():
    rng = random.Random(5)
    line = lambda n: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 5) for _ in range(n))
    passages = ["\n".join(line(rng.randrange(2, 12)) for _ in range(rng.randrange(2, 9))) for _ in range(6)] + [line(60), line(50)]
    rows = []
    for i in range(80):
        body = [line(rng.randrange(0, 20)) for _ in range(rng.randrange(0, 12))]
        for p in rng.sample(passages, 2):
            body.insert(rng.randrange(len(body) + 1), p)
        rows.append((i, "\n".join(body)))
    return rows + [(200, None), (201, ""), (202, "\n\n\n"), (203, "\n\n\n"), (204, rows[0][1]), (205, "one"), (206, "one\r\n é\t\n"), (207, "x\n" * 5000)]


def test_equals_brute_force(spark):
    rows = _rows()
    docs = spark.createDataFrame([(*r, "a", "b", 1, 2) for r in rows], SCHEMA).repartition(4)
    out = line_chunks.deduplicated(docs)
    assert out.columns == ["doc_id", "text", "lines", "at", "_cuts", "removed_chunks", "removed_lines"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == plain.without_repeats(rows)
    assert got != dict(rows)


def test_long_repeated_lines_go_wherever_they_stand(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"own line {i}\n{passage}\nanother line {i}", None, None, 0, 0) for i in range(20)]
    got = {r.doc_id: r.text for r in line_chunks.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert passage in got[0] and all(got[i] == f"own line {i}\nanother line {i}" for i in range(1, 20))


def test_whole_passages_go_and_stay_once(spark):
    """Passages of several lines between own lines: every copy goes whole, each passage stays somewhere."""
    rng = random.Random(8)
    line = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    passages = [[line(rng.randrange(8, 30)) for _ in range(rng.randrange(4, 9))] for _ in range(10)]
    rows = []
    for i in range(120):
        rows.append((i, "\n".join([line(5), line(6), *passages[i % 10], line(7), line(4)]), None, None, 0, 0))
    got = {r.doc_id: r.text.split("\n") for r in line_chunks.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()}
    left = sum(x in p for i, lines in got.items() for x in lines for p in [passages[i % 10]])
    assert left <= 1.3 * sum(map(len, passages))
    assert all(any(x in lines for lines in got.values()) for p in passages for x in p)
    assert all(set(rows[i][1].split("\n")) - set(passages[i % 10]) <= set(lines) for i, lines in got.items())


def test_no_passage_of_over_fifty_words_is_missed(spark):
    """Short passages of long lines, which hold few chunk boundaries, with other lines around."""
    rng = random.Random(9)
    line = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passages = [[line(rng.randrange(13, 21)) for _ in range(4)] for _ in range(200)]
    rows = [(i, "\n".join([line(6), *p, line(9)]), None, None, 0, 0) for i, p in enumerate(passages + passages)]
    got = {r.doc_id: r.text.split("\n") for r in line_chunks.deduplicated(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()}
    for i, p in enumerate(passages):
        assert set(p) <= set(got[i]) and not set(p) & set(got[200 + i])
        own = [x for x in rows[200 + i][1].split("\n") if x not in p]
        assert got[200 + i] == own


def test_a_passage_repeated_within_one_text_leaves_no_fragments(spark):
    rng = random.Random(10)
    line = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passage = [line(rng.randrange(2, 14)) for _ in range(300)]
    body = []
    for i in range(20):
        body += [line(7), *passage[:150], "", *passage[150:]]
    rows = [(1, "\n".join(body), None, None, 0, 0)]
    (got,) = line_chunks.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()
    left = got.text.split("\n")
    assert sum(x in set(passage) for x in left) == 300 and len([x for x in left if x]) == 320


def test_texts_that_share_a_digest_are_told_apart(spark, monkeypatch):
    """With digests of two bits nearly all texts share one; only equal bytes are repeats."""
    rows = _rows()[:60]
    docs = spark.createDataFrame([(*r, "a", "b", 1, 2) for r in rows], SCHEMA).repartition(3)
    hashed = line_chunks.F.xxhash64
    short = lambda *columns: hashed(*columns) % 4 if len(columns) == 2 else hashed(*columns)
    monkeypatch.setattr(line_chunks.F, "xxhash64", short)
    assert {r.doc_id: r.text for r in line_chunks.deduplicated(docs).collect()} == plain.without_repeats(rows)


def test_boundaries_resist_shifts():
    rng = random.Random(2)
    lines = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(6)) for _ in range(200)]
    cut = {"\n".join(c) for _, c in plain.line_chunks("\n".join(lines))}
    shifted = {"\n".join(c) for _, c in plain.line_chunks("\n".join(["new first line", *lines[:90], "inserted", *lines[90:]]))}
    assert len(cut & shifted) >= len(cut) - 4


def test_copies_of_a_row_are_one_document(spark):
    text = "first line\nsecond line\nthird line\nfourth line"
    rows = [(1, text, None, None, 0, 0), (1, text, None, None, 0, 0), (None, text, None, None, 0, 0), (1, "other", None, None, 0, 0)]
    got = sorted(((r.doc_id, r.removed_chunks > 0) for r in line_chunks.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted([(1, False), (1, False), (1, False), (None, any(len(c) > 1 for _, c in plain.line_chunks(text)))], key=repr)


def test_empty_table(spark):
    assert line_chunks.deduplicated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = line_chunks.deduplicated(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
