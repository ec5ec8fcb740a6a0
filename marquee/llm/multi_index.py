"""Hard-negative mining by integer inner product with an inverted multi-index.

Vectors are cut in two halves, each half goes to the nearest entry of a codebook of its own, and the pair of entries is
the vector's cell. An entry's radius is the largest distance of a half that belongs to it, so for an anchor q no vector
of cell (i, j) scores above

    q1 . c_i + |q1| r_i  +  q2 . d_j + |q2| r_j.

A heap over the two sorted lists of half bounds visits the cells of an anchor in falling order of that sum. A search
stops where the bound falls below what the window still needs, so its result is exact:

1. probe: cells until ``probe_rows`` rows are met; the sixth best row of the anchor's label gives a limit,
2. complete: all further cells whose bound reaches the limit. Now the positives are certain, and with them, for every
   positive, the window of scores that a negative may have,
3. probe again for negatives; the third best in each window gives its limit (the low end of the window while there are
   fewer),
4. complete again.

Plan: rows of equal label and vector fold to one that keeps the few smallest ids a result can need, so a very common
vector costs as much as any; anchors fold likewise. Codebooks are fitted on a bounded sample, every row is assigned, and
radii cover all rows. What is broadcast are two codebooks of at most ``MOST_ENTRIES`` entries and one count per cell. A
cell is met in parts of at most ``PART`` vectors and ``PART`` anchors, so no task grows with a cell or with the number of
anchors that visit it; a part returns the best few of each anchor. Every step is a written table. Cells are written
without vectors, which join where a part is met.

Vectors meet only vectors of their own length. Those of another than the most frequent length share one cell per length,
without a bound.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.text import sampled
from marquee.session import materialize

EVERY = 50
POSITIVES = 5
NEGATIVES = 3
LEAST_PERCENT, MOST_PERCENT = 50, 95  # of the positive's score
SCALE = 256
SAMPLE = 20_000  # the most vectors that the codebooks are fitted on
ROUNDS = 10
CELL_ROWS = 1024
MOST_ENTRIES = 512  # per codebook; at most its square of cells are counted in a broadcast
PROBE_ROWS = 4096
PART = 4096
SLICE = 256  # anchors that are multiplied with a part at once
SEED = 19

_EXACT = float(1 << 53)  # sums of products below this are exact in double precision
_FOUND = "anchor_no bigint, slot int, no bigint, score bigint"


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Components as integers, floor(scale * x); beyond 64 bits they end at its limits."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))


def usable(rows: DataFrame, key: str, label: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, label, vec), once each, of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    plain = rows.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("raw"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND raw IS NOT NULL").filter(F.forall("raw", finite))
    return plain.select("id", "label", quantised(F.col("raw"), scale).alias("vec")).distinct()


def folded(rows: DataFrame, kept: int) -> DataFrame:
    """(no, label, vec, dims, ids): equal rows as one, with their ``kept`` smallest ids in order.

    The rank limit runs before the shuffle as well.
    """
    order = Window.partitionBy("label", "vec").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= kept)
    grouped = few.groupBy("label", "vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return grouped.select(
        F.monotonically_increasing_id().alias("no"), "label", "vec", F.size("vec").alias("dims"), "ids"
    )


@dataclass
class Codebooks:
    """Entries and radii of both halves, and the number of rows in each cell, for vectors of length ``dims``."""

    dims: int
    first: np.ndarray
    second: np.ndarray
    radius_1: np.ndarray | None = None
    radius_2: np.ndarray | None = None
    held: np.ndarray | None = None

    @property
    def cut(self) -> int:
        return self.first.shape[1]


def _kmeans(points: np.ndarray, entries: int, rng: np.random.Generator) -> np.ndarray:
    centres = points[rng.choice(len(points), entries, replace=False)]
    for _ in range(ROUNDS):
        nearest, _ = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        count = np.bincount(nearest, minlength=entries)[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the distance to it, which is computed from the difference."""
    found = np.empty(len(points), np.int32)
    for low in range(0, len(points), 4096):
        part = points[low:low + 4096]
        found[low:low + 4096] = np.argmin((centres * centres).sum(1) - 2 * (part @ centres.T), 1)
    return found, np.linalg.norm(points - centres[found], axis=1)


def fit(vectors: DataFrame, sample: int = SAMPLE, entries: int | None = None) -> Codebooks | None:
    """Codebooks of both halves for the most frequent length; None without vectors."""
    lengths = vectors.groupBy("dims").agg(F.count("*").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), "dims").first()
    if usual is None:
        return None
    dims, n = usual["dims"], usual["rows"]
    rows = sampled(vectors.filter(F.col("dims") == dims).select("no", "vec"), "no", sample).collect()
    points = np.array([row["vec"] for row in rows], np.float64).reshape(len(rows), dims)
    entries = entries or round((n / CELL_ROWS) ** 0.5)
    entries = int(min(max(1, entries), MOST_ENTRIES, len(points)))
    rng, cut = np.random.default_rng(SEED), dims // 2
    return Codebooks(dims, _kmeans(points[:, :cut], entries, rng), _kmeans(points[:, cut:], entries, rng))


def assigned(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """Every vector with its cell (c1, c2) and the distances of its halves to their entries."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        books = shared.value
        for part in parts:
            cells = pd.DataFrame({"c1": 0, "c2": 0, "d1": 0.0, "d2": 0.0}, index=part.index)
            usual = (part["dims"] == books.dims).to_numpy()
            if usual.any():
                points = np.stack(part["vec"].to_numpy()[usual]).astype(np.float64)
                c1, d1 = _nearest(points[:, :books.cut], books.first)
                c2, d2 = _nearest(points[:, books.cut:], books.second)
                for name, values in (("c1", c1), ("c2", c2), ("d1", d1), ("d2", d2)):
                    cells.loc[usual, name] = values
            yield pd.concat([part, cells], axis=1)

    schema = "no bigint, label bigint, vec array<bigint>, dims int, ids array<bigint>, c1 int, c2 int, d1 double, d2 double"
    return vectors.mapInPandas(run, schema)


def measured(cells: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks with radii and cell sizes over all rows; at most ``MOST_ENTRIES`` squared rows come back."""
    k1, k2 = len(books.first), len(books.second)
    books.radius_1, books.radius_2, books.held = np.zeros(k1), np.zeros(k2), np.zeros((k1, k2), np.int64)
    sizes = cells.filter(F.col("dims") == books.dims).groupBy("c1", "c2").agg(
        F.count("*").alias("n"), F.max("d1").alias("r1"), F.max("d2").alias("r2")
    )
    for c1, c2, n, r1, r2 in sizes.toLocalIterator():
        books.held[c1, c2] = n
        books.radius_1[c1], books.radius_2[c2] = max(books.radius_1[c1], r1), max(books.radius_2[c2], r2)
    return books


def half_bounds(half: np.ndarray, entries: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """No half that belongs to an entry has a larger product with ``half``; rounding is allowed for."""
    product, reach = entries @ half, np.linalg.norm(half) * radius
    return product + reach + 1e-9 * (np.abs(entries) @ np.abs(half) + reach) + 1e-6


def visits(u: np.ndarray, v: np.ndarray, held: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(bound, i, j) of the cells in falling order of u[i] + v[j], those that hold rows.

    The multi-sequence heap: a cell of the two sorted lists enters when its upper and its left neighbour have left.
    """
    a, b = np.argsort(-u, kind="stable"), np.argsort(-v, kind="stable")
    su, sv = u[a], v[b]
    heap = [(-(su[0] + sv[0]), 0, 0)]
    passed = np.full(len(u), -1)  # the last column of each row that has left
    while heap:
        bound, i, j = heapq.heappop(heap)
        passed[i] = j
        if held[a[i], b[j]]:
            yield -bound, int(a[i]), int(b[j])
        if i + 1 < len(su) and (j == 0 or passed[i + 1] == j - 1):
            heapq.heappush(heap, (-(su[i + 1] + sv[j]), i + 1, j))
        if j + 1 < len(sv) and (i == 0 or passed[i - 1] >= j + 1):
            heapq.heappush(heap, (-(su[i] + sv[j + 1]), i, j + 1))


def probed(anchors: DataFrame, books: Codebooks, probe_rows: int) -> DataFrame:
    """(anchor_no, dims, c1, c2): the first cells of each anchor, until they hold ``probe_rows`` rows."""
    return _planned(anchors, books, lambda row: (0, probe_rows, -np.inf))


def completed(anchors: DataFrame, books: Codebooks, probe_rows: int) -> DataFrame:
    """The cells after the probed ones whose bound reaches the anchor's ``need``."""
    return _planned(anchors, books, lambda row: (probe_rows, np.inf, row.need))


def _planned(anchors: DataFrame, books: Codebooks, limits) -> DataFrame:
    """Cells of each anchor between two numbers of rows met, while the bound reaches a limit."""
    shared = anchors.sparkSession.sparkContext.broadcast(books)

    def cells_of(row, books: Codebooks) -> Iterator[tuple[int, int]]:
        after, until, need = limits(row)
        if row.dims != books.dims:
            if after == 0:
                yield 0, 0
            return
        q = np.asarray(row.vec, np.float64)
        u = half_bounds(q[:books.cut], books.first, books.radius_1)
        v = half_bounds(q[books.cut:], books.second, books.radius_2)
        met = 0
        for bound, i, j in visits(u, v, books.held):
            if met >= until or bound < need:
                return
            if met >= after:
                yield i, j
            met += books.held[i, j]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for low in range(0, len(part), 64):
                out = [(r.no, r.dims, i, j) for r in part.iloc[low:low + 64].itertuples() for i, j in cells_of(r, shared.value)]
                yield pd.DataFrame(out, columns=["anchor_no", "dims", "c1", "c2"])

    return anchors.mapInPandas(run, "anchor_no bigint, dims int, c1 int, c2 int")


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Inner products of all rows of q with all rows of p, exact; beyond 64 bits they end at its limits."""
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(p.astype(np.float64)).max(initial=0)) * q.shape[1]
    if most < _EXACT:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    if most < 2.0 ** 62:
        return q.astype(np.int64) @ p.astype(np.int64).T
    exact = q.astype(object) @ p.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _best(scores: np.ndarray, allowed: np.ndarray, first_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest allowed scores of each row, the smaller first id first among equals."""
    floor = np.iinfo(np.int64).min
    if scores.shape[1] > k:
        masked = np.where(allowed, scores, floor)
        limit = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        allowed = allowed & (scores >= limit[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((first_ids[column], -scores[row, column].astype(np.float64), row))
    # Doubles order scores up to 2**53; beyond that equal doubles are told apart by the integers.
    if len(order) and np.abs(scores[row, column].astype(np.float64)).max() >= _EXACT:
        order = np.array(sorted(order, key=lambda i: (row[i], -int(scores[row[i], column[i]]), first_ids[column[i]])))
    row, column = row[order], column[order]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.array([], int)
    rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
    return row[rank < k], column[rank < k]


def searched(planned: DataFrame, anchors: DataFrame, cells: DataFrame, slots, kept: int, part: int = PART) -> DataFrame:
    """(anchor_no, slot, no, score): the ``kept`` best of each anchor and slot within every part of every planned cell.

    ``slots`` takes scores, equality of labels and the anchors of a slice and yields (slot, allowed) matrices.
    """
    key = ["dims", "c1", "c2"]
    shape = cells.groupBy(*key).agg(F.count("*").alias("rows")).join(
        planned.groupBy(*key).agg(F.count("*").alias("asked")), key
    ).select(*key, F.ceil(F.col("rows") / part).cast("int").alias("v_parts"), F.ceil(F.col("asked") / part).cast("int").alias("q_parts"))
    spread = lambda name, count: F.pmod(F.xxhash64(name), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = cells.join(shape, key).select(
        *key, spread("no", "v_parts").alias("v_part"), every("q_parts").alias("q_part"), "no", "label", "vec",
        F.get("ids", F.lit(0)).alias("first_id"),
    )
    right = (
        planned.join(shape, key)
        .select(*key, every("v_parts").alias("v_part"), spread("anchor_no", "q_parts").alias("q_part"), "anchor_no")
        .join(anchors.drop("dims").withColumnRenamed("no", "anchor_no"), "anchor_no")
    )

    def run(points: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(points) and len(asking):
            p, label = np.stack(points["vec"].to_numpy()), points["label"].to_numpy()
            no, first = points["no"].to_numpy(), points["first_id"].to_numpy()
            for low in range(0, len(asking), SLICE):
                some = asking.iloc[low:low + SLICE]
                scores = products(np.stack(some["vec"].to_numpy()), p)
                same = some["label"].to_numpy()[:, None] == label
                for slot, allowed in slots(scores, same, some):
                    row, column = _best(scores, allowed, first, kept)
                    found.append(pd.DataFrame({
                        "anchor_no": some["anchor_no"].to_numpy()[row], "slot": np.int32(slot), "no": no[column],
                        "score": scores[row, column],
                    }))
        return pd.concat(found) if found else pd.DataFrame({"anchor_no": [], "slot": [], "no": [], "score": []})

    by = [*key, "v_part", "q_part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, _FOUND)


def _of_same_label(scores, same, some):
    """One slot: rows of the anchor's label, from what the anchor still needs on."""
    yield 0, same & (scores >= some["need"].to_numpy()[:, None])


def _in_windows(scores, same, some):
    """A slot per window of the anchors; those with fewer windows have none in the later slots."""
    lows, highs = some["lows"].to_numpy(), some["highs"].to_numpy()
    for slot in range(max(map(len, lows), default=0)):
        has = np.array([len(one) > slot for one in lows])
        low = np.array([one[slot] if len(one) > slot else 0 for one in lows], np.int64)[:, None]
        high = np.array([one[slot] if len(one) > slot else 0 for one in highs], np.int64)[:, None]
        yield slot, ~same & has[:, None] & (scores >= low) & (scores <= high)


def _rows(found: DataFrame, cells: DataFrame, kept: int) -> DataFrame:
    """Found vectors as rows (anchor_no, slot, id, score, n), the ``kept`` first of each anchor and slot."""
    order = Window.partitionBy("anchor_no", "slot").orderBy(F.desc("score"), "id")
    named = found.join(cells.select("no", "ids"), "no").select("anchor_no", "slot", F.explode("ids").alias("id"), "score")
    return named.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= kept)


def _search(anchors: DataFrame, cells: DataFrame, books: Codebooks, slots, kept: int, limit, name: str, probe_rows: int, part: int) -> DataFrame:
    """The certain ``kept`` first rows of each anchor and slot: probe, derive what is still needed, complete.

    ``limit`` gives the anchors with what they need after the rows found so far.
    """
    first = materialize(probed(anchors, books, probe_rows), f"{name}-probe")
    near = materialize(_rows(searched(first, anchors, cells, slots, kept, part), cells, kept), f"{name}-near")
    needing = materialize(limit(anchors, near), f"{name}-needing")
    more = materialize(completed(needing, books, probe_rows), f"{name}-more")
    far = _rows(searched(more, needing, cells, slots, kept, part), cells, kept)
    order = Window.partitionBy("anchor_no", "slot").orderBy(F.desc("score"), "id")
    both = near.drop("n").unionByName(far.drop("n")).withColumn("n", F.row_number().over(order))
    return materialize(both.filter(F.col("n") <= kept), f"{name}-found")


def hard_negatives(
    rows: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", every: int = EVERY,
    positives: int = POSITIVES, negatives: int = NEGATIVES, least_percent: int = LEAST_PERCENT,
    most_percent: int = MOST_PERCENT, scale: int = SCALE, probe_rows: int = PROBE_ROWS, part: int = PART,
    entries: int | None = None, sample: int = SAMPLE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact.

    Anchors are the rows whose key is divisible by ``every``. Positives are an anchor's best rows of its own label,
    negatives the best rows of another label whose score lies between the two percentages of the positive's. Equal
    scores go to the smaller key. A positive without negatives gives no rows.

    Rows without a key or label, with a null vector, or with a null or non-finite component take no part. Only vectors
    of one length are compared; empty vectors score 0. Equal rows count once; rows that share a key and differ are rows
    of their own, an anchor's other rows are those with another key, and each row of an anchor's key asks. Components
    and scores beyond 64 bits end at its limits. No rows give no rows. Other columns are ignored.
    """
    spark = rows.sparkSession
    known = materialize(usable(rows, key, label, vector, scale), "hard-rows")
    wanted = max(positives + 1, negatives)
    vectors = materialize(folded(known, wanted), "hard-vectors")
    books = fit(vectors, sample, entries)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if books is None:
        return spark.createDataFrame([], schema)
    cells = materialize(assigned(vectors, books), "hard-cells")
    books = measured(cells, books)
    cells = cells.drop("d1", "d2")

    owners = materialize(
        known.filter(F.col("id") % every == 0).join(vectors.select("label", "vec", "no"), ["label", "vec"]).select("id", F.col("no").alias("anchor_no")),
        "hard-owners",
    )
    asking = owners.select(F.col("anchor_no").alias("no")).distinct()
    lowest = F.lit(float("-inf"))
    wide = vectors.select("no", "label", "vec", "dims", lowest.alias("need"))
    anchors = materialize(wide.join(asking, "no", "left_semi"), "hard-anchors")

    def last_positive(anchors: DataFrame, near: DataFrame) -> DataFrame:
        last = near.filter(F.col("n") == positives + 1).select(F.col("anchor_no").alias("no"), F.col("score").cast("double").alias("need"))
        return anchors.drop("need").join(last, "no", "left").withColumn("need", F.coalesce("need", lowest))

    same = _search(anchors, cells, books, _of_same_label, positives + 1, last_positive, "hard-positives", probe_rows, part)

    # A window per distinct score of a positive: ceil(score * least / 100) to floor(score * most / 100).
    score = F.col("score").cast("decimal(20,0)")
    low = F.ceil(score * least_percent / F.lit(100)).cast("long")
    high = F.floor(score * most_percent / F.lit(100)).cast("long")
    windows = materialize(
        same.select("anchor_no", F.col("score").alias("positive_score"), low.alias("low"), high.alias("high")).distinct()
        .filter("low <= high")
        .withColumn("slot", F.row_number().over(Window.partitionBy("anchor_no").orderBy("positive_score")) - 1),
        "hard-windows",
    )
    def with_windows(anchors: DataFrame, windows: DataFrame) -> DataFrame:
        """Anchors that have windows, with the ends of each and the lowest of them."""
        ends = F.array_sort(F.collect_list(F.struct("slot", "low", "high")))
        limits = windows.groupBy(F.col("anchor_no").alias("no")).agg(ends.alias("w"), F.min("low").cast("double").alias("need"))
        return anchors.select("no", "label", "vec", "dims").join(limits, "no").select(
            "no", "label", "vec", "dims", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"), "need"
        )

    def last_negative(anchors: DataFrame, near: DataFrame) -> DataFrame:
        last = near.filter(F.col("n") == negatives).select("anchor_no", "slot", "score")
        return with_windows(anchors, windows.join(last, ["anchor_no", "slot"], "left").withColumn("low", F.coalesce("score", "low")))

    windowed = materialize(with_windows(anchors, windows), "hard-windowed")
    other = _search(windowed, cells, books, _in_windows, negatives, last_negative, "hard-negatives", probe_rows, part)

    order = Window.partitionBy("anchor_id", "anchor_no").orderBy(F.desc("positive_score"), "positive_id")
    chosen = (
        owners.withColumnRenamed("id", "anchor_id")
        .join(same.select("anchor_no", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "anchor_no")
        .filter("positive_id <> anchor_id")
        .withColumn("n", F.row_number().over(order)).filter(F.col("n") <= positives).drop("n")
    )
    answers = other.join(windows.select("anchor_no", "slot", "positive_score"), ["anchor_no", "slot"]).select(
        "anchor_no", "positive_score", F.col("n").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return chosen.join(answers, ["anchor_no", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
