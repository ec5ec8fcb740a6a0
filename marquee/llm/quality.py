"""Quality rules: an isolation forest over rule statistics of a text.

The statistics are shares that a rule would look at (symbols, repeated lines and windows, capitals, ...). The
forest is grown on a bounded sample of labelled texts: every tree splits ``TREE_ROWS`` of them at random values of
random statistics, and texts that are cut off after few splits are unusual. The score, 2^(-mean path / expected
path), is near 1 for anomalies. The threshold comes from all labelled rows: the score that separates good from bad
best, counted in a histogram.

Plan: one pass over the texts in Arrow batches gives the statistics, which are written once; fitting reads a
sample of fixed size, calibration is a grouped count, and scoring runs the trees over column arrays.
"""

from __future__ import annotations

import operator
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import batches, sampled, small_batches, text_digest
from marquee.session import materialize

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 20
REPEAT_PERCENT = 30

TREES = 100
TREE_ROWS = 256
SAMPLE_ROWS = 20_000  # the most labelled rows that the forest is grown on
SCORE_STEPS = 1000
SEED = 7

# What a rule allows before a share counts; the statistics are the excess over it, so that sound texts of all
# languages look alike and only breaches spread the values.
ALLOWED_CAPITALS = 0.15
ALLOWED_DIGITS = 0.3
ALLOWED_STUTTER = 0.05

FEATURES = ("symbol_share", "symbol_words", "capitals", "shouts", "digits", "stutter")
STATISTICS = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), *[(name, pa.float64()) for name in FEATURES],
    ("text_digest", pa.binary()),
])
STATISTICS_DDL = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    + ", ".join(f"{name} double" for name in FEATURES) + ", text_digest binary"
)
_SYMBOL = re.compile(rb"[#*$%&|<>]")
_DIGITS = bytes(range(48, 58))
_TABLE = 0x530  # capitals of the Latin, Greek and Cyrillic blocks
_IS_CAPITAL = np.array([chr(i).isupper() for i in range(_TABLE)] + [False])


def _dup_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(" \t\v\f\r")]
    return len(lines) - len(set(lines))


def repeated_window_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur at least twice in the text, the first one included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    joined = b" ".join(words)
    starts = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
    at, to = starts[:n].tolist(), (starts[width:] - 1).tolist()
    windows = [joined[a:b] for a, b in zip(at, to, strict=True)]
    if len(set(windows)) == n:
        return 0
    first: dict[bytes, int] = {}
    again = np.zeros(n, dtype=bool)
    for i, window in enumerate(windows):
        j = first.setdefault(window, i)
        if j != i:
            again[i] = again[j] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    hit = np.flatnonzero(again)
    np.add.at(edges, hit, 1)
    np.add.at(edges, hit + width, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def _without(raw: bytes, some: bytes) -> int:
    return len(raw) - len(raw.translate(None, some))


def _excess(share: float, allowed: float) -> float:
    """Square root of what exceeds the allowed share: small breaches stand clear of none."""
    return max(0.0, share - allowed) ** 0.5


def statistics_of(text: str | None) -> tuple:
    """Counts of the rules and, from them and a few more, the shares that the forest reads."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - _without(raw, b" \t\n\v\f\r")
    symbols, dup, repeats = _without(raw, SYMBOLS), _dup_lines(text), repeated_window_words(words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    capitals = int(_IS_CAPITAL[np.minimum(points, _TABLE)].sum())
    marked = sum(1 for word in words if _SYMBOL.search(word)) if symbols else 0
    stutter = sum(map(operator.eq, words, words[1:]))
    per_char, per_word = 1.0 / max(chars, 1), 1.0 / max(n, 1)
    return (
        n, chars, symbols, dup, repeats,
        _excess(symbols * per_char, 0.0), _excess(marked * per_word, 0.0),
        _excess(capitals * per_char, ALLOWED_CAPITALS), _excess(_without(raw, b"!") * per_word, 0.0),
        _excess(_without(raw, _DIGITS) * per_char, ALLOWED_DIGITS), _excess(stutter * per_word, ALLOWED_STUTTER),
    )


def statistics(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Statistics of every whole text, null texts as empty."""

    def run(parts):
        def rows():
            for part in parts:
                keys, digests = part.column(0).to_pylist(), part.column(2).to_pylist()
                for key, text, digest in zip(keys, part.column(1), digests, strict=True):
                    yield key, *statistics_of(text.as_py()), digest

        yield from batches(STATISTICS, rows())

    small_batches(docs)
    return docs.select(F.col(key).cast("long").alias("doc_id"), "text", text_digest(F.col("text"))).mapInArrow(run, STATISTICS_DDL)


def _expected_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=np.float64)
    long = 2.0 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2.0 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


@dataclass
class Tree:
    """Nodes in arrays: the statistic and value that split a node, its children, and the depth of a leaf."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray


def grow(rows: np.ndarray, rng: np.random.Generator) -> Tree:
    deepest = int(np.ceil(np.log2(max(len(rows), 2))))
    feature, value, left, right, path = [], [], [], [], []

    def node(part: np.ndarray, depth: int) -> int:
        at = len(feature)
        feature.append(-1), value.append(0.0), left.append(at), right.append(at), path.append(0.0)
        low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(1), np.zeros(1))
        usable = np.flatnonzero(high > low)
        if depth >= deepest or len(part) <= 1 or not len(usable):
            path[at] = depth + float(_expected_path(len(part)))
            return at
        f = int(rng.choice(usable))
        v = float(rng.uniform(low[f], high[f]))
        below = part[:, f] < v
        feature[at], value[at] = f, v
        left[at] = node(part[below], depth + 1)
        right[at] = node(part[~below], depth + 1)
        return at

    node(rows, 0)
    return Tree(np.array(feature), np.array(value), np.array(left), np.array(right), np.array(path))


@dataclass
class Forest:
    trees: list[Tree]
    tree_rows: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for tree in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            while True:
                f = tree.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                below = rows[every, np.maximum(f, 0)] < tree.value[at]
                at = np.where(inner, np.where(below, tree.left[at], tree.right[at]), at)
            total += tree.path[at]
        return np.exp2(-total / len(self.trees) / max(float(_expected_path(self.tree_rows)), 1e-9))


def fit_forest(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    """Grow the trees, each on its own draw of ``tree_rows`` of the rows."""
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(rows))
    return Forest([grow(rows[rng.choice(len(rows), size, replace=False)], rng) for _ in range(trees)], size)


def _sample(stats: DataFrame, bound: int) -> np.ndarray:
    rows = sampled(stats.select("doc_id", *FEATURES), "doc_id", bound, *FEATURES).toPandas()
    return rows[list(FEATURES)].to_numpy(dtype=np.float64)


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """Statistics with the column ``anomaly``."""
    schema = pa.schema([*STATISTICS, ("anomaly", pa.float64())])

    def run(parts):
        for part in parts:
            matrix = np.column_stack([part.column(name).to_numpy() for name in FEATURES])
            values = pa.array(forest.scores(matrix), pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns, values], schema=schema)

    return stats.select(*STATISTICS.names).mapInArrow(run, STATISTICS_DDL + ", anomaly double")


def calibrated_threshold(labelled: DataFrame) -> float:
    """The score above which a text is rejected, from (anomaly, quality) of all labelled rows.

    Both classes are counted per score step; the step with the largest difference between the share of bad rows
    and the share of good rows above it wins, the middle one of equal neighbours. Without rows of both classes
    nothing is rejected.
    """
    step = F.floor(F.col("anomaly") * SCORE_STEPS).cast("int").alias("step")
    counts = labelled.groupBy(step).agg(
        F.sum(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("quality") <= 0, 1).otherwise(0)).alias("bad"),
    )
    good, bad = np.zeros(SCORE_STEPS + 2), np.zeros(SCORE_STEPS + 2)
    for row in counts.collect():  # a row per score step
        good[row["step"]], bad[row["step"]] = row["good"], row["bad"]
    if not good.sum() or not bad.sum():
        return float("inf")
    above = np.cumsum(bad[::-1])[::-1] / bad.sum() - np.cumsum(good[::-1])[::-1] / good.sum()
    first = int(np.argmax(above))
    last = first
    while last + 1 < len(above) and above[last + 1] == above[first]:
        last += 1
    return (first + last) / 2 / SCORE_STEPS


def judge(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", sample_rows: int = SAMPLE_ROWS, digests: bool = False
) -> DataFrame:
    """Statistics, ``base_failed``, ``anomaly`` and ``kept`` of every document, with ``digests`` also ``text_digest``,
    which tells the texts of one key apart.

    ``labels`` has (doc_id, quality), 1 good and 0 bad; several labels of a document count as its lowest, null
    ones are ignored. The forest is grown on at most ``sample_rows`` labelled texts that pass the base rules; where
    none is labelled, on as many others, and then nothing but the base rules rejects. Null and empty texts have no
    words and fail the base. Repeated rows are judged alike; no documents give no rows.
    """
    stats = materialize(statistics(docs, key), "quality-statistics")
    named = [*STATISTICS.names[:6], *(["text_digest"] if digests else [])]
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    known = labels.filter("quality IS NOT NULL").groupBy(F.col("doc_id").alias("doc_id")).agg(F.min("quality").alias("quality"))
    labelled = stats.filter(~failed).join(known, "doc_id")
    rows = _sample(labelled, sample_rows)
    if not len(rows):
        rows = _sample(stats, sample_rows)
    if not len(rows):
        return stats.select(*named, failed.alias("base_failed"), F.lit(None).cast("double").alias("anomaly"), (~failed).alias("kept"))
    forest = fit_forest(rows)
    threshold = calibrated_threshold(scored(stats.filter(~failed), forest).select("doc_id", "anomaly").join(known, "doc_id"))
    return scored(stats, forest).select(
        *named, failed.alias("base_failed"), "anomaly", (~failed & (F.col("anomaly") < threshold)).alias("kept")
    )
