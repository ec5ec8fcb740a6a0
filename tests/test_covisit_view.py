"""The maintained view of co-visitation against a full computation and brute force."""

import itertools
import random
from collections import Counter

import pytest

from marquee.operators import covisit
from marquee.operators import covisit_view as V


def frame(spark, rows):
    return spark.createDataFrame(sorted(rows), "user_id string, item_id string")


def batches(seed, users=25, titles=18, sizes=(120, 60, 5, 0, 80)):
    """Batches of visits with repeats within and between them, and one user of all titles."""
    rng = random.Random(seed)
    out = []
    for n, size in enumerate(sizes):
        rows = [(f"u{int(users * rng.random() ** 2):02d}", f"m{rng.randrange(titles):02d}") for _ in range(size)]
        rows += [("u99", f"m{i:02d}") for i in range(n, titles, 3)] if size else []
        out.append(rows)
    return out


def edges(table):
    return sorted(tuple(r) for r in table.select(
        "source_item_id", "neighbor_item_id", "shared_users", "source_users", "neighbor_users", "score").collect())


def brute_pairs(visits):
    by_user = {}
    for user, item in visits:
        by_user.setdefault(user, set()).add(item)
    pairs = Counter(p for items in by_user.values() for p in itertools.combinations(sorted(items), 2))
    users = Counter(i for items in by_user.values() for i in items)
    return sorted((a, b, n, users[a], users[b], round(n / (users[a] * users[b]) ** 0.5, 6)) for (a, b), n in pairs.items())


@pytest.mark.parametrize("per_split", [3, 500])
def test_pair_counts_equal_brute_force(spark, per_split):
    visits = set(itertools.chain(*batches(1)))
    got = sorted(tuple(r) for r in V.pair_counts(frame(spark, visits), per_split).collect())
    assert got == brute_pairs(visits)


@pytest.mark.parametrize("seed", [2, 3])
def test_view_equals_full_training_after_every_batch(spark, tmp_path, seed):
    view, seen = V.View(str(tmp_path)), set()
    for n, rows in enumerate(batches(seed)):
        seen |= set(rows)
        got = V.apply_batch(view, frame(spark, rows), n, top_k=4, compact_every=2)
        assert edges(got) == edges(covisit.covisit_edges(frame(spark, seen), top_k=4))
    stored = view.pairs.read(spark).groupBy("item_id", "other_id").sum("shared").collect()
    assert {(a, b): n for a, b, n in stored if a < b} == {(a, b): n for a, b, n, *_ in brute_pairs(seen)}
    assert view.visits.read(spark).count() == len(seen) and view.pairs.bases(spark) == [1, 3]


def test_applied_and_failed_batches_can_come_again(spark, tmp_path, monkeypatch):
    view, (first, second, *_) = V.View(str(tmp_path)), batches(4)
    V.apply_batch(view, frame(spark, first), 0)
    before = edges(view.edges(spark))
    assert edges(V.apply_batch(view, frame(spark, second), 0)) == before  # already applied

    def broken(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(V, "ranked", broken)
    with pytest.raises(RuntimeError):
        V.apply_batch(view, frame(spark, second), 1)
    assert edges(view.edges(spark)) == before and view.applied(spark) == 0
    monkeypatch.undo()
    got = V.apply_batch(view, frame(spark, second), 1)
    assert edges(got) == edges(covisit.covisit_edges(frame(spark, set(first + second))))


def test_untouched_titles_are_not_ranked_again(spark, tmp_path, monkeypatch):
    view = V.View(str(tmp_path))
    V.apply_batch(view, frame(spark, [("u1", "a"), ("u1", "b"), ("u2", "c"), ("u2", "d")]), 0)
    ranked, asked = V.ranked, []

    def watching(pairs, support, top_k):
        asked.extend(r.item_id for r in pairs.select("item_id").distinct().collect())
        return ranked(pairs, support, top_k)

    monkeypatch.setattr(V, "ranked", watching)
    V.apply_batch(view, frame(spark, [("u3", "c"), ("u3", "e")]), 1)
    assert sorted(asked) == ["c", "d", "e"]
    assert edges(view.edges(spark)) == edges(covisit.covisit_edges(
        frame(spark, [("u1", "a"), ("u1", "b"), ("u2", "c"), ("u2", "d"), ("u3", "c"), ("u3", "e")])))
