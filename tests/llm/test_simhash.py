import itertools
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm import simhash
from marquee.llm.components import components
from tests.llm import plain


def test_any_five_positions_hold_a_quadruple():
    chosen = simhash.quadruples()
    assert len(set(chosen)) == 14
    assert all(any(set(q) <= set(five) for q in chosen) for five in itertools.combinations(range(8), 5))


def test_fingerprint_agrees_with_spark_and_plain(spark):
    texts = ["One two", "a B  c\td", "", None, "É é É", "x " * 50, "word", "\x1c odd space", "a b c a b c"]
    for text in texts:
        assert simhash.fingerprint(text) == plain.fingerprint(text)
    row = spark.range(1).select(F.xxhash64(F.lit("one two")).alias("h")).first()
    assert simhash.fingerprint("One two") == row.h


def test_blocks_do_not_change_a_fingerprint(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(3000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 64)
    assert simhash.fingerprint(text) == whole == plain.fingerprint(text)


@pytest.mark.parametrize("longest", [256, 3])
def test_links_equal_brute_force(spark, longest):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for b in base[:5]:
        for _ in range(60):
            x = b
            for _ in range(rng.randrange(1, 7)):
                x ^= 1 << rng.randrange(20)
            prints.add(x)
    prints = sorted(simhash._signed(x) for x in prints)
    want = {(a, b) for a, b in itertools.combinations(prints, 2) if plain.near(a, b)}
    nodes = spark.createDataFrame([(x,) for x in prints], "fp long")
    assert {tuple(r) for r in simhash.links(nodes, longest).collect()} == want


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(7, 5), (200, 200), (301, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    want = plain.groups({n for pair in pairs for n in pair}, pairs)
    del want[200]  # a link to itself
    assert got == want


def _documents():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randrange(2, 8)))
    texts = [" ".join(word() for _ in range(rng.randrange(1, 400))) for _ in range(60)]
    for text in texts[:30]:
        parts = text.split(" ")
        parts[rng.randrange(len(parts))] = "changed"
        texts += [" ".join(parts), text.upper(), text]
    return list(enumerate([*texts, None, "", " \n ", "one", "One"], start=5))


def test_groups_equal_brute_force(spark):
    rows = _documents()
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp int, root int")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == plain.fingerprint_groups(rows)
    similar = plain.similar_groups(rows)
    assert {r.doc_id: r["group"] for r in simhash.similar_groups(docs).collect()} == similar
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(similar.values()))


def test_wide_fingerprints_equal_plain():
    for text in ["One two three two", "word", "", None, " ".join(f"w{i % 83}" for i in range(2000))]:
        value = plain.wide_fingerprint(text)
        assert simhash.wide_fingerprint(text) == [simhash._signed(value >> 64 * i & (1 << 64) - 1) for i in range(8)]


def test_similar_texts_are_found_and_others_left(spark):
    """Texts with every sixtieth word changed share more than 0.8 of their five-word shingles."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    rows, pairs = [], []
    for n in range(150):
        w = [rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else word() for _ in range(rng.randrange(120, 600))]
        rows.append((2 * n, " ".join(w)))
        changed = [word() if i % 60 == 7 else x for i, x in enumerate(w)]
        rows.append((2 * n + 1, " ".join(changed)))
        pairs.append(plain.five_word_similarity(rows[-1][1], rows[-2][1]))
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, node int, wide int")
    group = {r.doc_id: r["group"] for r in simhash.similar_groups(docs).collect()}
    close = [n for n in range(150) if pairs[n] >= 0.8]
    assert len(close) > 75 and sum(group[2 * n + 1] == 2 * n for n in close) >= 0.95 * len(close)
    assert all(group[i] // 2 == i // 2 for i in group)  # nothing joins unrelated texts


@pytest.mark.parametrize("longest", [256, 16])
def test_all_pairs_of_a_long_list_are_met(spark, longest):
    """Fingerprints that agree in one triple, as shared boilerplate makes them: a pair has only that list in common."""
    rng = random.Random(4)
    in_list = simhash._triples()[0]
    loose = [p for p in range(64) if p not in in_list]
    free = set(rng.sample([p for p in loose if p % 3 == 0], 16))  # bytes that a pair shares besides
    rows, node = [], 0
    for _ in range(90):
        one = [0 if p in in_list else rng.randrange(256) for p in range(64)]
        two = [b if p in in_list or p in free else b ^ 1 for p, b in enumerate(one)]
        for byte in (one, two):
            whole = sum(b << 8 * p for p, b in enumerate(byte))
            rows.append((node, [simhash._signed(whole >> 64 * i & (1 << 64) - 1) for i in range(8)]))
            node += 1
    bits = [sum((x & (1 << 64) - 1) << 64 * i for i, x in enumerate(wide)) for _, wide in rows]
    want = plain.groups(range(node), [(a, b) for a, b in itertools.combinations(range(node), 2) if (bits[a] ^ bits[b]).bit_count() <= 56])
    nodes = spark.createDataFrame(rows, "node long, wide array<long>")
    assert simhash.leader_links(nodes).count() < 10  # one member of the list alone is not enough
    got = simhash.similar_components(nodes, longest=longest)
    assert {r.node: r.root for r in got.collect()} == want
    assert all(want[n] == n // 2 * 2 for n in want)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b c"), (2, "a b c"), (2, "a b c"), (None, "lonely"), (9, "x" * 200_000)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(None, 2), (2, 2), (2, 2), (None, None), (9, 9)], key=repr)
    assert sorted((r.doc_id for r in simhash.representatives(docs).collect()), key=repr) == [2, 9, None]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
