import numpy as np
import pytest

from marquee.llm import ann
from tests.llm import plain

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, ids string"


def frame(spark, ids, matrix):
    rows = [(int(i), [float(x) for x in v], 0, "c", "d") for i, v in zip(ids, matrix, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def answers(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


@pytest.mark.parametrize("part", [ann.PART, 20])
def test_all_lists_probed_equals_brute_force(spark, part):
    rng = np.random.default_rng(3)
    matrix = rng.normal(0, 1, (400, 24)).astype(np.float32)
    matrix[50:90] = matrix[7]  # equal vectors and ties
    matrix[100:110] = 2 * matrix[9]
    ids = np.arange(400)
    got = answers(ann.nearest(frame(spark, ids, matrix), share=1.0, every=10, part=part))
    want = plain.cosine_nearest(ids, matrix.astype(np.float64), 10, 5)
    assert got.keys() == want.keys()
    right = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert right >= 0.99 * 5 * len(want)
    for q, rows in got.items():
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        score = {i: s for i, s in plain.cosine_nearest(ids, matrix.astype(np.float64), q or 400, 399)[q]}
        assert all(abs(score[i] - s) < 1e-12 for i, s in rows)
    assert [i for i, _ in got[50]] == [7, 51, 52, 53, 54]


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    table = rows.orderBy("vec_id").collect()
    ids, matrix = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], dtype=np.float64)
    got, want = answers(ann.nearest(rows)), plain.cosine_nearest(ids, matrix, 50, 5)
    right = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and right >= 0.9 * 5 * len(want)


def test_scan_abandons_only_what_is_far():
    rng = np.random.default_rng(4)
    points, queries = ann.unit(rng.normal(0, 1, (3000, 64))), ann.unit(rng.normal(0, 1, (40, 64)))
    distance, which = ann.scan(queries, points, 5)
    exact = ((queries[:, None] - points[None]) ** 2).sum(2)
    right = sum(len(set(np.argsort(exact[i])[:5]) & set(which[i])) for i in range(40))
    assert right >= 198
    assert np.allclose(distance, np.take_along_axis(exact, which, 1))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []),
        (50, [1.0, 0.0]), (50, [1.0, 0.0]), (100, None), (None, [1.0, 0.0]), (150, [1.0, 2.0, 3.0]), (8, [-1.0, 0.0]), (200, [1e30, 1e30]),
    ]
    df = spark.createDataFrame([(*r, 0, "", "") for r in rows], SCHEMA)
    got = answers(ann.nearest(df))
    assert set(got) == {0, 50, 200}
    assert [i for i, _ in got[0]] == [50, 1, 200, 8]
    assert [i for i, _ in got[50]] == [0, 1, 200, 8]


def test_empty_and_single(spark):
    assert ann.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert ann.nearest(spark.createDataFrame([(0, [1.0], 0, "", "")], SCHEMA)).count() == 0
