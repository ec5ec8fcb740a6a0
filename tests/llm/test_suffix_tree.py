import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from marquee.llm import suffix_tree
from tests.llm import plain

SETTINGS = {"depth": 3, "least_share": 0.002, "least_gain": 2.0, "prior": 4.0}


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def brute(rows, settings):
    learned = [w for key, text in rows if not held(key) for w in [*suffix_tree.words_of(text), b""]]
    counts = Counter(learned)
    score, chance, kept = plain.tree_probability(learned, *(settings[k] for k in ("depth", "least_share", "least_gain", "prior")))
    out = []
    for key, text in rows:
        tokens = [*suffix_tree.words_of(text), b""]
        base = sum(math.log10((counts[t] + 1) / (len(learned) + len(counts) + 1)) for t in tokens)
        out.append((key, held(key), len(tokens), sum(counts[t] > 0 for t in tokens), len(learned), base, sum(map(score, tokens))))
    return out, chance, kept


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=repr), sorted(want, key=repr), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9)


def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in docs.collect()][:60]


@pytest.mark.parametrize("frequent", [5, 100_000])
def test_equals_brute_force(spark, frequent):
    rows = [*corpus(spark), (900, None), (901, ""), (902, "Ünseen \x1c wörds"), (None, "the The"), (900, None), (905, "w" * 5000)]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, word string, n long").repartition(3)
    want, _, kept = brute(rows, SETTINGS)
    assert any(len(c) > 1 for c in kept)
    same([tuple(r) for r in suffix_tree.score_texts(docs, frequent=frequent, **SETTINGS).collect()], want)


def test_distributions_add_up_to_one(spark):
    _, chance, kept = brute(corpus(spark), SETTINGS)
    for context in kept:
        assert sum(chance(context, a) for a in range(256)) == pytest.approx(1.0)


def test_contexts_help_on_held_out_texts(spark):
    """Deeper trees give held-out texts a higher probability."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    means = []
    for depth in (1, 2, 6):
        rows = suffix_tree.score_texts(docs, depth=depth).filter("held_out").selectExpr("sum(score) / sum(n_tokens) AS m").first()
        means.append(rows.m)
    assert means == sorted(means)


def test_small_buffers_change_nothing(spark, monkeypatch):
    rows = corpus(spark)[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {bytes(r.word): r.n for r in suffix_tree.word_counts(docs).collect()}[b""] == sum(not held(i) for i, _ in rows)


def test_nothing_to_learn_from(spark):
    keys = [i for i in range(60) if held(i)]
    rows = [(i, "some words") for i in keys]
    got = suffix_tree.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.n_known for r in got} == {0} and {r.train_tokens for r in got} == {0}
    assert got[0].score == pytest.approx(-math.log10(256) * (5 + 6 + 1))


def test_empty_table(spark):
    assert suffix_tree.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def text_model(lines, depth, least_share, least_gain, prior):
    """A function from texts to log10 probabilities, by counting every context of every text in a dictionary."""
    counts = defaultdict(Counter)
    for line in lines:
        body = b"\n" * depth + line
        for i in range(depth, len(body)):
            for k in range(depth + 1):
                counts[body[i - k:i]][body[i]] += 1
    total = {c: sum(row.values()) for c, row in counts.items()}
    everything = total.get(b"", 0)
    kept = {b""}
    for c in counts:
        if c and total[c] >= least_share * everything:
            gain = sum(n * math.log(n / total[c] * total[c[1:]] / counts[c[1:]][a]) for a, n in counts[c].items())
            if gain >= least_gain:
                kept |= {c[i:] for i in range(len(c))}

    def chance(c, a):
        if not c:
            return (counts[b""][a] + 1) / (everything + 256)
        return (counts[c][a] + prior * chance(c[1:], a)) / (total[c] + prior)

    def score(line):
        body = b"\n" * depth + line
        longest = lambda i: next(body[i - k:i] for k in range(depth, -1, -1) if body[i - k:i] in kept)
        return sum(math.log10(chance(longest(i), body[i])) for i in range(depth, len(body)))

    return score, kept


def test_texts_equal_brute_force_across_words(spark):
    """Contexts hold the ends of the words before; three tasks find them together."""
    rows = [*corpus(spark), (900, None), (901, ""), (902, "Ünseen \x1c wörds"), (None, "the The"), (900, None), (905, "w" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lines = [suffix_tree.line_of(text) for _, text in rows]
    for depth in (3, 6):
        settings = {**SETTINGS, "depth": depth}
        score, kept = text_model(
            [line for (key, _), line in zip(rows, lines, strict=True) if not held(key)],
            *(settings[k] for k in ("depth", "least_share", "least_gain", "prior")),
        )
        assert any(b" " in c[1:-1] for c in kept)
        got = suffix_tree.score_texts(docs, across_words=True, frequent=50, **settings).collect()
        base, _, _ = brute(rows, SETTINGS)
        same([tuple(r) for r in got], [(*row[:6], score(line)) for row, line in zip(base, lines, strict=True)])


def test_chunks_and_pieces_change_nothing():
    lines = [suffix_tree.line_of(text) for text in ("some words", "", "w" * 100, None, "The end")]
    whole, = suffix_tree.text_symbols(lines, 3)
    small = list(suffix_tree.text_symbols(lines, 3, most=7))
    assert len(small) > 10
    for name in ("context", "symbol", "text"):
        assert (np.concatenate([getattr(one, name) for one in small]) == getattr(whole, name)).all()
    assert bytes(whole.symbol.astype(np.uint8).tolist()) == b"".join(lines)


def test_order_of_words_counts(spark):
    rows = [(i, "alpha beta gamma delta " * 20) for i in range(40)] + [(900, "alpha beta gamma delta"), (901, "delta alpha gamma beta")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_tree.score_texts(docs, across_words=True).filter("doc_id >= 900").collect()}
    assert got[900].base_score == pytest.approx(got[901].base_score)
    assert got[900].score > got[901].score + 1


def test_across_words_without_texts_to_learn_from(spark):
    rows = [(i, "some words") for i in range(60) if held(i)]
    got = suffix_tree.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), across_words=True).collect()
    assert len(got) == len(rows) and got[0].score == pytest.approx(-math.log10(256) * (5 + 6 + 1))
    assert suffix_tree.score_texts(spark.createDataFrame([], "doc_id long, text string"), across_words=True).count() == 0


def test_places_of_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 59, 5000))
    places = suffix_tree.Places(keys)
    assert (places.find(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(np.arange(3000), keys)
    assert (places.find(others) == -1).all() and len(suffix_tree.Places(keys[:0]).find(others)) == len(others)
