"""Registered queries against their SQL, and the pipeline against plain versions of its stages."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from marquee.llm import pieces, quality
from marquee.llm.queries import QUERIES, SQL
from tests.llm import plain

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "labels", "pages", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{ROOT}/{name}.parquet'")
    return connection


def _plain_value(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, ROOT)
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    got = sorted(repr([_plain_value(r[c]) for c in sorted(columns)]) for r in result.collect())
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert got == sorted(repr([_plain_value(row[i]) for i in order]) for row in cursor.fetchall())


def test_near_dedup_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash_near_dedup"](spark, ROOT).collect()}
    groups = plain.fingerprint_groups(rows)
    assert got == {i: (f"{plain.fingerprint(t) & (1 << 64) - 1:016x}", groups[i]) for i, t in rows}


def test_quality_query(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    for r in QUERIES["op4_quality_rules"](spark, ROOT).collect():
        counts = plain.rule_counts(rows[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])


def test_encoding_query(spark):
    rows = QUERIES["op5_merge_dropout"](spark, ROOT).collect()
    assert len(rows) == spark.read.parquet(f"{ROOT}/documents.parquet").count() and all(r.lossless for r in rows)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    raw = open(pieces.MODEL, "rb").read()
    encoder, reference = pieces.Encoder(pieces.PieceModel(raw), pieces.SEED, pieces.DROPOUT), plain.PieceAgenda(raw)
    for r in rows:
        assert list(r.tokens) == reference.encode(texts[r.doc_id] or "", encoder.document_key(r.doc_id), pieces.DROPOUT)


def _kept(docs, labels):
    """Documents that pass the rules, walking every tree by itself."""
    stats = {i: quality.statistics_of(t) for i, t, _ in docs}
    sound = {i for i, s in stats.items() if s[0] >= 20 and 100 * s[4] <= 30 * s[0]}
    features = {i: np.array(s[5:]) for i, s in stats.items()}
    known = {}
    for i, q in labels:
        known[i] = min(q, known.get(i, q))
    return sound, features, {i: q for i, q in known.items() if i in sound}


def test_pipeline_equals_plain_stages(spark):
    table = spark.read.parquet(f"{ROOT}/documents.parquet").collect()
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()]
    judged = {r.doc_id: r for r in quality.judge(spark.read.parquet(f"{ROOT}/documents.parquet"), spark.read.parquet(f"{ROOT}/labels.parquet")).collect()}
    sound, _, known = _kept([(r.doc_id, r.text, r.source) for r in table], labels)
    # The threshold must lie between the labelled classes as well as any score does.
    limit = min((judged[i].anomaly for i in sound if not judged[i].kept), default=math.inf)
    best = lambda cut: np.mean([judged[i].anomaly >= cut for i, q in known.items() if q == 0]) - np.mean([judged[i].anomaly >= cut for i, q in known.items() if q])
    assert best(limit) >= max(best(judged[i].anomaly) for i in known) - 0.05
    docs = [r for r in table if r.doc_id in sound and judged[r.doc_id].anomaly < limit]

    texts = plain.without_repeats([(r.doc_id, r.text) for r in docs])
    groups = plain.similar_groups(list(texts.items()))
    left = [r for r in docs if groups[r.doc_id] == r.doc_id]
    bad = {i for i in {i for i, _ in labels} if min(q for j, q in labels if j == i) == 0}
    times = plain.mixed([(r.doc_id, r.source, len(plain.words(texts[r.doc_id])), 0.25 if r.doc_id in bad else 1.0) for r in left])

    got = corpus_pipeline.run(spark, ROOT).collect()
    assert Counter(r.doc_id for r in got) == Counter({i: n for i, n in times.items() if n})
    model = pieces.PieceModel(open(pieces.MODEL, "rb").read())
    cut = {}
    for r in got:
        assert r.lossless and model.decode(r.tokens) == texts[r.doc_id]
        cut.setdefault(r.doc_id, set()).add(tuple(r.tokens))
    # Copies of a text are cut anew.
    assert all(len(cut[i]) == n for i, n in times.items() if n > 1 and len(plain.words(texts[i])) > 30)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, ROOT).columns == docs.columns


def _prose(rng, words=80):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(words))


def test_texts_of_null_and_repeated_ids_are_decided_one_by_one(spark):
    rng = random.Random(6)
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    sound = [_prose(rng) for _ in range(6)]
    rows = [(None, t) for t in sound[:3]] + [(10**6, t) for t in sound[3:]] + [(None, "too short"), (10**6, None), (10**6, "a " * 40)]
    odd = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], docs.schema)
    kept = corpus_pipeline.quality_rules(spark, docs.unionByName(odd), ROOT).filter("doc_id IS NULL OR doc_id = 1000000")
    assert sorted(r.text for r in kept.collect()) == sorted(sound)


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    rng = random.Random(7)
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    texts = [_prose(rng) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (5, texts[3]), (4, texts[4])]
    rows += [(5, texts[4].upper()), (None, texts[4]), (9, texts[5]), (8, texts[5]), (9, texts[5])]
    odd = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], docs.schema)
    want = sorted([(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (4, texts[4]), (8, texts[5])], key=repr)
    for parts in (1, 5):
        got = corpus_pipeline.near_dedup(spark, odd.repartition(parts), ROOT).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=repr) == want


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    labels = spark.read.parquet(f"{ROOT}/labels.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "s", 0), (3, None, "en", None, None)], docs.schema)
    for name, rows in (("empty", docs.limit(0)), ("odd", docs.unionByName(odd).unionByName(docs.limit(3)))):
        root = str(tmp_path / name)
        rows.write.parquet(f"{root}/documents.parquet")
        (labels if name == "odd" else labels.limit(0)).write.parquet(f"{root}/labels.parquet")
        assert (corpus_pipeline.run(spark, root).count() > 0) == (name == "odd")
