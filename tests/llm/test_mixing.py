import random

from pyspark.sql import functions as F

from marquee.llm import mixing
from tests.llm import plain

SCHEMA = "doc_id long, source string, size long, quality double, key string, draw double, target string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1.0, "t") for r in rows], SCHEMA)


def _rows(n=600, seed=1):
    rng = random.Random(seed)
    sources = ["b", "a", None, "é", "Z", "tiny", "empty"]
    rows = []
    for i in range(n):
        source = "a" if rng.random() < 0.4 else rng.choice(sources)
        size = 0 if source == "empty" else rng.randrange(1, 5) if source == "tiny" else rng.randrange(0, 500)
        rows.append((i, source, size, rng.choice([1.0, 1.0, 0.25])))
    return rows


def test_equals_brute_force(spark):
    rows = _rows()
    got = {r.doc_id: r for r in mixing.mix(frame(spark, rows)).collect()}
    times, goal = plain.mixed(rows), plain.targets({s: sum(r[2] for r in rows if r[1] == s) for s in {r[1] for r in rows}})
    for key, source, size, _ in rows:
        assert got[key].taken == size * times[key], key
        assert abs(got[key].target - goal[source]) < 1e-6
    for source in goal:
        mine = [got[r[0]] for r in rows if r[1] == source]
        assert abs(sum(r.taken for r in mine) - goal[source]) <= max(r.size for r in mine) / 2 + 1
        assert all(r.taken <= 3 * r.size for r in mine)


def test_reruns_and_layouts_agree(spark):
    rows = frame(spark, _rows(200, 2))
    first = sorted(map(tuple, mixing.mix(rows).collect()), key=repr)
    assert first == sorted(map(tuple, mixing.mix(rows.repartition(7)).collect()), key=repr)


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, s, 10, 1.0 if i % 2 else 0.2) for i in range(4000) for s in ("a",)] + [(i, "b", 10, 1.0) for i in range(4000, 12000)]
    got = mixing.mix(frame(spark, rows)).filter("source = 'b' OR source = 'a'").withColumn("odd", F.col("doc_id") % 2)
    shares = {(r.source, r.odd): r.share for r in got.groupBy("source", "odd").agg((F.sum("taken") / F.sum("size")).alias("share")).collect()}
    assert shares[("a", 1)] > shares[("a", 0)] + 0.1


def test_odd_rows(spark):
    rows = [(None, None, None, None), (1, "a", 5, -1.0), (1, "a", 5, -1.0), (2, "a", 0, 1.0)]
    got = mixing.mix(frame(spark, rows)).collect()
    assert len(got) == 4 and sum(r.taken for r in got) == 10
    assert mixing.mix(frame(spark, [(1, "a", 0, 1.0)])).first().taken == 0
    assert mixing.mix(frame(spark, [])).count() == 0


def test_repeated_documents_keep_their_columns(spark):
    rows = [(1, "a", 10, 1.0), (2, "b", 1000, 1.0), (None, "b", 100, 1.0)]
    docs = frame(spark, rows).withColumnRenamed("draw", "_times")
    mixed = mixing.mix(docs)
    out = mixing.repeated(docs, mixed)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixed.collect()}
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.size
    assert got == {k: v for k, v in taken.items() if v}


def test_plan_has_no_python(spark):
    plan = mixing.mix(frame(spark, _rows(10)).select("doc_id", "source", "size", "quality"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_null_and_repeated_ids_are_emitted_as_often_as_taken(spark):
    """The words of the mixed corpus are the words taken, whatever the ids."""
    rows = [(None, "a", f"{'x ' * (1 + i % 7)}{i}") for i in range(60)] + [(7, "b", f"{'y ' * (1 + i % 5)}{i}") for i in range(30)]
    rows += [(None, "b", "same text here")] * 9 + [(i, "c", "z " * (1 + i % 9)) for i in range(100, 300)] + [(None, None, None), (8, "a", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    mixed = mixing.mix(mixing.sized_documents(docs, labels), carried=("digest",))
    taken = mixed.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("target")).collect()
    out = mixing.repeated(docs, mixed, digest=F.unhex(F.md5(F.coalesce(docs["text"], F.lit("")))))
    assert out.columns == docs.columns
    words = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " +"))).alias("n")).collect()}
    assert words == {r.source: r.n for r in taken if r.n}
    assert all(abs(r.n - r.target) <= 5 for r in taken if r.source in ("a", "b", "c"))
    most = out.groupBy("doc_id", "text").count().join(docs.groupBy("doc_id", "text").agg(F.count("*").alias("rows")), ["doc_id", "text"])
    assert most.filter("count > 3 * rows").count() == 0


def test_documents_without_ids_draw_apart(spark):
    docs = spark.createDataFrame([(None, "a", f"word {i}") for i in range(500)] + [(1, "b", "x " * 5000)], "doc_id long, source string, text string")
    sized = mixing.sized_documents(docs, spark.createDataFrame([], "doc_id long, quality int"))
    draws = sized.select(mixing._uniform(F.col("doc_id"), "s", F.hex("digest")).alias("u")).distinct().count()
    assert draws == 501
