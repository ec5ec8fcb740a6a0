import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marquee.functions import blocks
from marquee.operators import content
from marquee.session import shuffle_files_removed


def brute_force(texts, top_k):
    bags = {i: Counter(re.findall(r"\w\w+", text.lower())) for i, text in texts.items()}
    df = Counter(term for bag in bags.values() for term in bag)
    vectors = {}
    for i, bag in bags.items():
        raw = {t: n * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t, n in bag.items()}
        norm = math.sqrt(sum(w * w for w in raw.values())) or 1.0
        vectors[i] = {t: w / norm for t, w in raw.items()}
    result = set()
    for i, vector in vectors.items():
        scores = []
        for j, other in vectors.items():
            if i != j:
                dot = sum(w * other.get(t, 0.0) for t, w in vector.items())
                scores.append((-math.floor(min(dot, 1.0) * 1e6 + 0.5) / 1e6, j))
        result |= {(i, j, -score) for score, j in sorted(scores)[:top_k]}
    return result


def corpus(seed):
    """Random texts over a few words; every text holds one common word, a third are copies."""
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(40)]
    texts = {f"d{i:03d}": " ".join(["every", *rng.choices(words, k=rng.randint(1, 9))]) for i in range(60)}
    texts |= {f"d{i:03d}": "every copy reads word1 word2" for i in range(60, 95)}
    texts |= {"d100": "", "d101": "?!", "d102": "solitary", "d103": "every"}
    return texts


@pytest.mark.parametrize(("seed", "block"), [(1, 2048), (2, 7), (3, 20)])
def test_neighbors_equal_brute_force(spark, seed, block):
    texts = corpus(seed)
    df = spark.createDataFrame(sorted(texts.items()), "item_id string, text string")
    rows = content.content_neighbors(df, top_k=4, stop_words=(), block_vectors=block).collect()
    got = {(row["source_item_id"], row["neighbor_item_id"], row["score"]) for row in rows}
    assert len(rows) == 4 * len(texts)
    assert got == brute_force(texts, 4)


def test_vectors_stay_where_bounds_are_below_their_matches(spark):
    """Texts of separate topics: only blocks that share a topic meet, and the result is that of all pairs."""
    rng = random.Random(5)
    texts = {}
    for topic in range(12):
        words = [f"t{topic}w{i}" for i in range(6)]
        for i in range(20):
            texts[f"d{topic:02d}{i:02d}"] = f"topic{topic} " + " ".join(rng.choices(words, k=5)) + f" own{topic}x{i}"
    df = spark.createDataFrame(sorted(texts.items()), "item_id string, text string")
    got = content.content_neighbors(df, top_k=3, stop_words=(), block_vectors=20)
    assert {tuple(r) for r in got.select("source_item_id", "neighbor_item_id", "score").collect()} == brute_force(texts, 3)

    folded, vectors = content._fold_copies(df, ())
    cut, n = content._cut_into_blocks(content._vectors_with_weights(folded, vectors), 20)
    within = cut.groupBy("block").applyInPandas(blocks.matches_within(3), blocks.MATCHES)
    bounded = content._with_bounds(cut, within, 3)
    assert n >= 12 and content._shipped(bounded, n).count() < 0.3 * cut.count() * (n - 1)


def test_upper_bounds_hold():
    rng = np.random.default_rng(8)
    for seed in range(20):
        n, vocabulary = 30, 25
        weights = rng.random((n, vocabulary)) * (rng.random((n, vocabulary)) < 0.3)
        weights[:, 0] += 0.01
        weights /= np.linalg.norm(weights, axis=1, keepdims=True)
        order = np.argsort(-weights, axis=1)
        frame = pd.DataFrame({
            "v": np.arange(n), "block": 0, "bound": rng.random(n) * 0.8,
            "terms": [o[weights[i, o] > 0] for i, o in enumerate(order)],
            "weights": [weights[i, o][weights[i, o] > 0] for i, o in enumerate(order)],
        })
        left = frame[:15]
        index = pd.DataFrame([
            {"block": 1 + c // 2, "cell": c % 2, "terms": np.flatnonzero(weights[rows].max(0)), "tops": weights[rows].max(0)[weights[rows].max(0) > 0]}
            for c, rows in enumerate(np.array_split(np.arange(15, n), 4))
        ])
        found = blocks.asked_cells(left, index)
        asked = {(v, b) for v, others in found[found["v"].notna()][["v", "others"]].itertuples(index=False) for b in others}
        cells = set(found[found["cell"].notna()][["block", "cell"]].itertuples(index=False, name=None))
        for x in range(15):
            for c, rows in enumerate(np.array_split(np.arange(15, n), 4)):
                if (weights[rows] @ weights[x]).max() >= max(frame["bound"][x], 1e-6):
                    assert (x, 1 + c // 2) in asked and (1 + c // 2, c % 2) in cells, seed


def test_corpus_smaller_than_the_list(spark):
    df = spark.createDataFrame([("a", "one word"), ("b", "two words")], "item_id string, text string")
    rows = content.content_neighbors(df, stop_words=()).collect()
    assert {(row["source_item_id"], row["neighbor_item_id"], row["score"]) for row in rows} == {
        ("a", "b", 0.0), ("b", "a", 0.0)
    }


def test_dot_products_equal_dense_ones():
    rng = np.random.default_rng(5)

    def block(n):
        terms = [np.sort(rng.choice(400, size=rng.integers(1, 60), replace=False)) for _ in range(n)]
        terms = [np.union1d(t, [0, 1]) if i % 3 else t for i, t in enumerate(terms)]
        return pd.DataFrame({"v": range(n), "terms": terms, "weights": [rng.random(len(t)) for t in terms]})

    def dense(frame):
        matrix = np.zeros((len(frame), 400))
        for i, (terms, weights) in enumerate(zip(frame["terms"], frame["weights"], strict=True)):
            matrix[i, terms] = weights
        return matrix

    left, right = block(150), block(170)
    assert np.allclose(blocks._dot_products(left, right), dense(left) @ dense(right).T)


def test_stop_words_and_short_tokens_are_dropped(spark):
    df = spark.createDataFrame([("a", "The SEVERAL a Été x_1 x")], "item_id string, text string")
    found = defaultdict(int)
    for row in content.term_counts(df).collect():
        found[row["term"]] = row["tf"]
    assert dict(found) == {"été": 1, "x_1": 1}


def test_blocks_are_bounded_by_postings_and_vectors(spark):
    """Short vectors beside long ones: no block exceeds its bounds by more than one vector."""
    rows = [(v, [v % 7, 100], [0.5, 0.5]) for v in range(400)] + [
        (400 + v, list(range(200, 300)), [0.1] * 100) for v in range(100)
    ]
    vectors = spark.createDataFrame(rows, "v long, terms array<long>, weights array<double>")
    cut, blocks = content._cut_into_blocks(vectors, 60, 1000)
    sizes = [len(r["n"]) for r in cut.groupBy("block").agg(F.collect_list("v").alias("n")).collect()]
    postings = [r["n"] for r in cut.groupBy("block").agg(F.sum(F.size("terms")).alias("n")).collect()]
    assert sum(sizes) == 500 and max(sizes) <= 61 and max(postings) <= 1100 and len(sizes) <= blocks


def test_the_corpus_is_read_once(spark, tmp_path):
    """A corpus that changes between reads would change its copies."""
    df = spark.createDataFrame([(f"d{i}", f"word{i % 5} word{i % 3}") for i in range(30)], "item_id string, text string")
    reads = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            reads.add(part.num_rows)
            yield part

    content.similar_texts(df.mapInArrow(counted, df.schema), stop_words=()).collect()
    assert reads.value == 30


def test_copies_raise_the_bound(spark):
    """Texts with as many copies as the list is long have nothing to look for below a score of 1."""
    texts = {f"d{i}{c}": f"alpha beta{i} gamma{i % 2}" for i in range(6) for c in range(4 if i < 3 else 1)}
    df = spark.createDataFrame(sorted(texts.items()), "item_id string, text string")
    folded, vectors = content._fold_copies(df, ())
    cut, _ = content._cut_into_blocks(content._vectors_with_weights(folded, vectors), 3)
    nothing = spark.createDataFrame([], blocks.MATCHES)
    bounds = [row["bound"] for row in content._with_bounds(cut, nothing, 3).collect()]
    assert bounds.count(1.0) == 3 and len(bounds) == 6
    rows = content.content_neighbors(df, top_k=3, stop_words=(), block_vectors=3).collect()
    assert {(r["source_item_id"], r["neighbor_item_id"], r["score"]) for r in rows} == brute_force(texts, 3)


def test_terms_of_every_text_do_not_place_it(spark):
    """A catalog: the words that all titles hold say nothing about where a vector belongs."""
    rows = [(f"d{k}{g}{b}", f"size brand {k} {k} {g} {g} {b}") for k in ("hot", "old", "red") for g in ("ring", "bolt", "rod")
            for b in (f"b{i}" for i in range(10, 17))]
    df = spark.createDataFrame(rows, "item_id string, text string")
    folded, vectors = content._fold_copies(df, ())
    weights = content._vectors_with_weights(folded, vectors)
    term = {r["t"]: r["vectors"] for r in weights.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("vectors")).collect()}
    heads = [r["heads"] for r in weights.collect()]
    assert all(len(h) == 3 and [term[t] for t in h] == [21, 21, 9] for h in heads)


def test_the_vocabulary_is_not_broadcast(spark):
    df = spark.createDataFrame([(f"d{i}", f"word{i} every") for i in range(30)], "item_id string, text string")
    joined = content.with_frequency(content.term_counts(df, ()))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert {(r["term"], r["df"]) for r in joined.collect()} == {("every", 30), *((f"word{i}", 1) for i in range(30))}


@pytest.mark.parametrize("seed", [2, 3])
def test_squares_and_rounds_equal_brute_force(spark, monkeypatch, seed):
    """Squares of several blocks, and rounds that each move a part of the vectors."""
    for name, value in {"SQUARE_POSTINGS": 60, "LEAST_SIDES": 2, "ROUND_SHARE": 1, "ROUND_POSTINGS": 1, "CHUNK_POSTINGS": 60, "ASKING_BLOCKS": 2}.items():
        monkeypatch.setattr(content, name, value)
    texts = corpus(seed)
    df = spark.createDataFrame(sorted(texts.items()), "item_id string, text string")
    rows = content.content_neighbors(df, top_k=4, stop_words=(), block_vectors=6).collect()
    assert {(r["source_item_id"], r["neighbor_item_id"], r["score"]) for r in rows} == brute_force(texts, 4)


def test_a_vector_travels_once_per_square(spark):
    met = spark.createDataFrame([(7, list(range(7)) + list(range(8, 40)))], "block int, partners array<int>")
    squares = content._with_squares(met, 10).first()["squares"]
    assert [(s["low"], s["high"]) for s in squares] == [(0, 0), (0, 1), (0, 2), (0, 3)]
    assert [len(s["blocks"]) for s in squares] == [9, 10, 10, 10]


def test_at_most_k_matches_leave_a_square():
    """However many blocks meet there; the best of all of them."""
    rng = np.random.default_rng(4)
    weights = rng.random((60, 8))
    weights /= np.linalg.norm(weights, axis=1, keepdims=True)
    square = pd.DataFrame({
        "block": np.arange(60) // 10, "v": np.arange(60), "terms": [np.arange(8)] * 60, "weights": list(weights),
        "bound": 0.0, "low": 0, "high": 0,
    })
    square["blocks"] = [np.array([b for b in range(6) if b != own], np.int32) for own in square["block"]]
    found = blocks.matches_in_square(3)(square.sample(frac=1, random_state=1))
    units = np.floor(np.minimum(weights @ weights.T, 1) * 1e6 + 0.5)
    for x in range(60):
        others = sorted((-units[x, y], y) for y in range(60) if y // 10 != x // 10)[:3]
        mine = found[found["x"] == x]
        assert {(-round(s * 1e6), y) for s, y in zip(mine["score"], mine["y"])} == set(others)


@pytest.mark.parametrize("bound", [0, 400_000, 900_000])
def test_few_scores_that_reach_the_bound_are_the_best_ones(bound):
    rng = np.random.default_rng(6)
    dots = np.round(rng.random((40, 50)), 2) * (rng.random((40, 50)) < 0.5)
    x, y, bounds = np.arange(40), np.arange(100, 150), np.full(40, bound) + np.arange(40) * 1000
    for top_k in (2, 30):
        want = blocks._best(blocks._units(dots), x, y, bounds, top_k)
        got = blocks._best_reached(dots, x, y, bounds, top_k)
        assert set(got.itertuples(index=False, name=None)) == set(want.itertuples(index=False, name=None))


def test_shuffle_files_of_a_round_are_removed(spark, tmp_path):
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size())}

    before = held()
    with shuffle_files_removed(spark):
        spark.range(1000).repartition(5, "id").write.parquet(str(tmp_path / "rows"))
    assert not {name for name in held() - before if name.startswith("shuffle")}


def test_all_blocks_meet_where_the_index_saves_little(spark, monkeypatch):
    """Texts of few words that most share: a sample of blocks tells that nearly all ask each other, so the others do not ask."""
    monkeypatch.setattr(content, "MANY_BLOCKS", 2)
    monkeypatch.setattr(content, "SAMPLE_SHARE", 1)
    monkeypatch.setattr(content, "_asks", lambda *_: pytest.fail("all blocks ask the index"))
    for name, value in {"SQUARE_POSTINGS": 100, "LEAST_SIDES": 2, "ROUND_SHARE": 1, "ROUND_POSTINGS": 1}.items():
        monkeypatch.setattr(content, name, value)
    rng = random.Random(11)
    texts = {f"d{i:03d}": " ".join(rng.choices([f"word{w}" for w in range(14)], k=7)) for i in range(90)}
    df = spark.createDataFrame(sorted(texts.items()), "item_id string, text string")
    rows = content.content_neighbors(df, top_k=4, stop_words=(), block_vectors=10).collect()
    assert {(r["source_item_id"], r["neighbor_item_id"], r["score"]) for r in rows} == brute_force(texts, 4)


def test_blocks_hold_texts_of_one_language(spark, monkeypatch):
    monkeypatch.setattr(content, "MANY_BLOCKS", 2)
    monkeypatch.setattr(content, "TOPICS", 2)
    rng = random.Random(3)
    rows = []
    for i in range(200):
        first = 0 if i % 2 else 30
        terms = [first, *rng.sample(range(first + 1, first + 30), 6)]
        rows.append((i, terms, [0.6] + [0.32] * 6, [rng.randrange(10_000)]))
    vectors = spark.createDataFrame(rows, "v long, terms array<long>, weights array<double>, heads array<long>")
    cut, _ = content._cut_into_blocks(vectors, 20)
    kinds = [r["kinds"] for r in cut.groupBy("block").agg(F.collect_set(F.col("v") % 2).alias("kinds")).collect()]
    assert len(kinds) == 10 and sum(len(k) > 1 for k in kinds) <= 1


def test_scores_that_single_precision_cannot_tell_apart():
    """More vectors than a list holds, whose scores differ by less than single precision resolves near a bound."""
    rng = np.random.default_rng(7)
    weights = np.vstack([rng.random((1, 300)), np.tile(rng.random((1, 300)), (39, 1)) + rng.random((39, 300)) * 2e-6])
    weights /= np.linalg.norm(weights, axis=1, keepdims=True)
    square = pd.DataFrame({
        "block": [0] + [1] * 39, "v": np.arange(40), "terms": [np.arange(300)] * 40, "weights": list(weights), "bound": 0.0,
    })
    square["blocks"] = [np.array([1 - own], np.int32) for own in square["block"]]
    found = blocks.matches_in_square(3)(square)
    units = np.floor(np.minimum(weights @ weights.T, 1) * 1e6 + 0.5)
    mine = found[found["x"] == 0]
    assert [(-round(s * 1e6), y) for s, y in zip(mine["score"], mine["y"])] == sorted((-units[0, y], y) for y in range(1, 40))[:3]
    assert all(found[found["x"] == y]["score"].round(6).tolist() == [units[0, y] / 1e6] for y in range(1, 40))
