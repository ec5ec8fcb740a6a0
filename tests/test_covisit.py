import random
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from marquee.operators import covisit


def brute_force(visits, top_k):
    by_user, users = defaultdict(set), Counter()
    for user, item in set(visits):
        by_user[user].add(item)
        users[item] += 1
    shared = Counter(pair for items in by_user.values() for pair in permutations(items, 2))
    best = defaultdict(list)
    for (a, b), n in shared.items():
        best[a].append((-(n * n) / users[b], b, n, users[a], users[b]))
    return {
        (a, b, n, na, nb, round(n / (na * nb) ** 0.5, 6))
        for a, found in best.items()
        for _, b, n, na, nb in sorted(found)[:top_k]
    }


def visits_with_large_users(seed, large):
    rng = random.Random(seed)
    items = [f"m{i:03d}" for i in range(60)]
    visits = [(f"u{u}", rng.choice(items)) for u in range(40) for _ in range(rng.randint(1, 7))]
    for u in range(large):
        visits += [(f"big{u}", item) for item in rng.sample(items, rng.randint(15, 55))]
    return visits


@pytest.mark.parametrize(("seed", "large", "limit"), [(1, 0, 500), (2, 1, 10), (3, 4, 10), (4, 3, 2)])
def test_edges_equal_brute_force(spark, seed, large, limit):
    visits = visits_with_large_users(seed, large)
    df = spark.createDataFrame(sorted(set(visits)), "user_id string, item_id string")
    edges = covisit.covisit_edges(df, top_k=5, pair_limit=limit)
    assert {tuple(row) for row in edges.collect()} == brute_force(visits, 5)


def test_one_user_with_every_title_and_a_third_of_all_rows(spark):
    items = [f"m{i:04d}" for i in range(300)]
    visits = [("all", item) for item in items]
    visits += [(f"u{i % 150}", items[(i * 7) % 300]) for i in range(600)]
    df = spark.createDataFrame(sorted(set(visits)), "user_id string, item_id string")
    edges = covisit.covisit_edges(df, top_k=8, pair_limit=20)
    assert {tuple(row) for row in edges.collect()} == brute_force(visits, 8)


def test_impressions_and_unknown_types_do_not_count(spark):
    rows = [("u", "a", "impression"), ("u", "b", "click"), ("u", "c", "shared"), ("u", "d", "complete")]
    events = spark.createDataFrame(rows, "user_id string, item_id string, event_type string")
    assert {row["item_id"] for row in covisit.user_items(events).collect()} == {"b", "d"}


def test_titles_of_many_users_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(covisit, "HOT_USERS", 4)
    monkeypatch.setattr(covisit, "LIST_TITLES", 6)
    monkeypatch.setattr(covisit, "TASK_PAIRS", 300)
    visits = visits_with_large_users(7, 4)
    df = spark.createDataFrame(sorted(set(visits)), "user_id string, item_id string")
    for limit in (500, 10):
        edges = covisit.covisit_edges(df, top_k=5, pair_limit=limit)
        assert {tuple(row) for row in edges.collect()} == brute_force(visits, 5)


def test_no_pair_is_moved_or_stored(spark, tmp_path, monkeypatch):
    """Every user shares a title with every other and has 39 of its own: what is written grows with the lists."""
    visits = [("u%d" % u, "all") for u in range(60)] + [("u%d" % u, "m%d-%d" % (u, i)) for u in range(60) for i in range(39)]
    df = spark.createDataFrame(visits, "user_id string, item_id string")
    rows = {}
    stored = covisit.materialize

    def counted(table, name):
        table = stored(table, name)
        rows[name] = table.count()
        return table

    monkeypatch.setattr(covisit, "materialize", counted)
    assert {tuple(row) for row in covisit.covisit_edges(df, top_k=2).collect()} == brute_force(visits, 2)
    pairs = sum(n * (n - 1) for n in [40] * 60)
    assert sum(rows.values()) < pairs / 4


@pytest.mark.parametrize("hot_users", [4, 20_000])
def test_rounds_of_large_users_equal_brute_force(spark, monkeypatch, hot_users):
    """Several rounds, users whose classes are cut, classes whose titles are dealt to several bins, and hot titles."""
    for name, value in {"HOT_USERS": hot_users, "LIST_TITLES": 6, "TASK_PAIRS": 300, "ROUND_PAIRS": 1500}.items():
        monkeypatch.setattr(covisit, name, value)
    visits = visits_with_large_users(9, 3)
    visits += [(user, f"n{i:02d}") for user in ("big0", "big1") for i in range(30)] + [("u0", "n00"), ("u1", "n00"), ("u1", "n07")]
    df = spark.createDataFrame(sorted(set(visits)), "user_id string, item_id string")
    edges = covisit.covisit_edges(df, top_k=5, pair_limit=10)
    assert {tuple(row) for row in edges.collect()} == brute_force(visits, 5)


def test_no_pair_of_classes_is_stored(spark, monkeypatch):
    """All users are large and hardly two titles have the same ones: what is written grows with the lists."""
    rng = random.Random(12)
    visits = [("u%d" % u, "m%d" % i) for u in range(60) for i in rng.sample(range(400), 40)]
    df = spark.createDataFrame(visits, "user_id string, item_id string")
    rows = {}
    stored = covisit.materialize

    def counted(table, name):
        table = stored(table, name)
        rows[name] = table.count()
        return table

    monkeypatch.setattr(covisit, "materialize", counted)
    assert {tuple(row) for row in covisit.covisit_edges(df, top_k=2, pair_limit=20).collect()} == brute_force(visits, 2)
    assert sum(rows.values()) < 60 * 40 * 39 / 4
