import numpy as np
import pytest

from marquee.llm import quality
from tests.llm import plain

TEXTS = [
    "", None, "a b c", "same line\nsame line\n\n\nother\nsame line", "w " * 40, " ".join(f"w{i % 10}" for i in range(45)),
    "#*$%&|<> é😀 \x1c x", "One\tTwo\vThree\fFour\rFive", "a b c d e f g h a b c d e f g h", " \n \n x\n \nx", "x" * 100_000,
    " ".join(f"tok{i}" for i in range(50)), " ".join(f"w{i}" for i in range(30)) + " tail " + " ".join(f"w{i}" for i in range(30)),
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts_equal_plain(text):
    assert quality.statistics_of(text)[:5] == plain.rule_counts(text)


def test_forest_isolates_what_is_far_away():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(0, 1, (1000, 3)), [[9, 9, 9]]])
    forest = quality.fit_forest(rows)
    scores = forest.scores(rows)
    assert scores.argmax() == 1000 and scores[-1] > 0.65 and np.median(scores) < 0.5


def _path(tree, row):
    at = 0
    while tree.feature[at] >= 0:
        at = tree.left[at] if row[tree.feature[at]] < tree.value[at] else tree.right[at]
    return tree.path[at]


def test_scores_equal_walking_each_tree():
    rng = np.random.default_rng(1)
    rows = rng.normal(0, 1, (400, 4))
    forest = quality.fit_forest(rows, trees=10, tree_rows=64)
    expected = 2 ** (-np.array([np.mean([_path(t, r) for t in forest.trees]) for r in rows]) / float(quality._expected_path(64)))
    assert np.allclose(forest.scores(rows), expected)


def test_labelled_junk_goes_and_the_rest_stays(spark):
    root = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels)
    rows = judged.join(labels, "doc_id").filter("NOT base_failed").select("kept", "quality").collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.02 * len(bad) and bad


def test_held_out_labels(spark):
    """Half of the labels calibrate, the other half is judged."""
    root = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels.filter("doc_id % 2 = 0"))
    rows = judged.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed").collect()
    right = sum(r.kept == (r.quality == 1) for r in rows)
    assert right >= 0.97 * len(rows)


LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, anomaly string, n_words string"


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(TEXTS)] + [(None, "x " * 5, None, None), (3, TEXTS[3], None, None)], DOCS)
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (4, None, None), (None, 1, 0), (99, 0, 0)], LABELS)
    rows = quality.judge(docs, labels).collect()
    assert len(rows) == len(TEXTS) + 2
    assert all(not r.kept for r in rows if r.base_failed) and any(r.kept for r in rows)


def test_without_labels_only_the_base_rejects(spark):
    docs = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(TEXTS)], DOCS)
    for r in quality.judge(docs, spark.createDataFrame([], LABELS)).collect():
        assert r.kept != r.base_failed


def test_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0
