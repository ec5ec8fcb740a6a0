"""Hard negatives against all pairs, and the visiting order of cells."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from marquee.llm import multi_index

ROWS = StructType([
    StructField("vec_id", LongType()), StructField("label", LongType()), StructField("embedding", ArrayType(DoubleType())),
])
RANGE = 1 << 63


def plain(rows, every=50):
    """All rows of the result by comparing every anchor with every row."""
    good = {
        (i, label, tuple(max(-RANGE, min(RANGE - 1, math.floor(256 * x))) for x in v)) for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, label, q in good:
        if i % every:
            continue
        scored = [
            (max(-RANGE, min(RANGE - 1, sum(a * b for a, b in zip(q, v, strict=True)))), j, other == label)
            for j, other, v in good if len(v) == len(q)
        ]
        best = sorted((-s, j) for s, j, same in scored if same and j != i)[:5]
        for s, j in best:
            fits = sorted((-t, k) for t, k, same in scored if not same and 50 * -s <= 100 * t <= 95 * -s)[:3]
            out += [(i, j, n, k, -s, -t) for n, (t, k) in enumerate(fits, 1)]
    return sorted(out)


def found(spark, rows, parts=3, **options):
    table = spark.createDataFrame(rows, ROWS).repartition(parts)
    return sorted(tuple(r) for r in multi_index.hard_negatives(table, **options).collect())


def clustered(rng, n, dims=8, groups=6, noise=0.3):
    centres = rng.standard_normal((groups, dims))
    at = rng.integers(0, groups, n)
    vectors = centres[at] + noise * rng.standard_normal((n, dims))
    return [(int(i), int(at[i] % 4), [float(x) for x in vectors[i]]) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"entries": 6, "probe_rows": 40, "part": 16}, {"entries": 9, "probe_rows": 1}])
def test_equals_all_pairs(spark, options):
    rows = clustered(np.random.default_rng(1), 420)
    want = plain(rows, every=20)
    assert want and found(spark, rows, every=20, **options) == want


def test_ties_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), int(rng.integers(0, 3)), [float(x) for x in rng.integers(-1, 2, 4) / 2]) for i in range(300)]
    rows += rows[:40] + [(0, 1, [0.5, 0.5, 0.0, 0.0]), (10, 2, [0.5, 0.5, 0.0, 0.0])]
    rows += [(1000 + i, 1, [0.5, 0.5, 0.5, 0.5]) for i in range(200)]  # a very common vector
    assert found(spark, rows, every=10, entries=3, probe_rows=20, part=32) == plain(rows, every=10)


def test_odd_rows_take_no_part(spark):
    rows = clustered(np.random.default_rng(3), 60)
    odd = [
        (100, None, [1.0] * 8), (100, 1, None), (None, 1, [1.0] * 8), (150, 1, [1.0] * 7 + [None]), (200, 1, [math.nan] * 8),
        (250, 1, [math.inf] * 8), (300, 2, []), (350, 1, []), (400, 1, [0.0] * 8), (500, 1, [1.0, 2.0]), (501, 2, [1.0, 1.0]),
        (502, 1, [0.5, 2.0]), (550, 0, [1e300, 1.0]), (551, 0, [1e300, 2.0]),
    ]
    assert found(spark, rows + odd) == plain(rows + odd)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(i % 3), [float(x) for x in 2.0**s * (1 + rng.random(4))]) for s in (24, 22) for i in range(90)]
    assert found(spark, rows, every=15, entries=3, probe_rows=10) == plain(rows, every=15)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == [] and found(spark, [(1, 1, None)]) == []
    rows = clustered(np.random.default_rng(5), 80)
    table = spark.createDataFrame(rows, ROWS)
    for name in ("id", "no", "vec", "dims", "c1", "anchor_no", "score", "need", "slot", "rank", "ids"):
        table = table.withColumn(name, F.lit("other"))
    assert sorted(tuple(r) for r in multi_index.hard_negatives(table).collect()) == plain(rows)


def test_cells_are_visited_in_falling_order_and_bounds_hold():
    rng = np.random.default_rng(6)
    points = rng.standard_normal((400, 5))
    centres = multi_index._kmeans(points, 7, rng)
    near, far = multi_index._nearest(points, centres)
    radius = np.array([far[near == i].max(initial=0) for i in range(7)])
    q = rng.standard_normal(5)
    u = multi_index.half_bounds(q, centres, radius)
    assert np.all(points @ q <= u[near])
    v = rng.standard_normal(9)
    held = rng.integers(0, 2, (7, 9))
    seen = list(multi_index.visits(u, v, held))
    assert sorted((i, j) for _, i, j in seen) == sorted(zip(*np.nonzero(held), strict=True))
    assert all(a >= b for (a, *_), (b, *_) in zip(seen, seen[1:]))


def test_a_search_stops_early_on_clustered_vectors(spark):
    rows = spark.createDataFrame(clustered(np.random.default_rng(7), 3000, groups=40, noise=0.05), ROWS)
    known = multi_index.usable(rows, "vec_id", "label", "embedding")
    vectors = multi_index.materialize(multi_index.folded(known, 6), "t")
    books = multi_index.fit(vectors, entries=24)
    cells = multi_index.materialize(multi_index.assigned(vectors, books), "t")
    books = multi_index.measured(cells, books)
    need = vectors.withColumn("need", F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x) * 0.8)
    visited = multi_index.probed(need, books, 1).unionByName(multi_index.completed(need, books, 1))
    met = visited.join(cells.groupBy("c1", "c2").count(), ["c1", "c2"]).agg(F.sum("count")).first()[0]
    assert met < 0.5 * 3000**2
