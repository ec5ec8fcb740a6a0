"""Best matches between the vectors of one block or of two, for use inside a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

MATCHES = "x long, y long, score double"
#: A vector with the blocks it asks, or a cell with the blocks that ask it.
ASKS = "block int, v long, cell int, others array<int>"
_MILLION = 1_000_000
# How the products of a term are added up depends on their number: terms with few of them together,
# terms with many as columns of dense matrices, the rest one by one.
_FEW, _MANY = 256, 5_000
_DENSE_COLUMNS = 512
_PRODUCTS_AT_ONCE = 2_000_000
# In single precision, terms with a product for one of so many cells are many. Scores that are sorted at once, and vectors
# whose topic is found at once.
_DENSE_SHARE = 800
_SCORES_AT_ONCE = 4_000_000
_ROWS_AT_ONCE = 2_000


def _postings(block: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of every posting, sorted by term."""
    lengths = block["terms"].str.len().to_numpy()
    rows = np.repeat(np.arange(len(block)), lengths)
    terms = np.concatenate(block["terms"].to_numpy())
    weights = np.concatenate(block["weights"].to_numpy())
    order = np.argsort(terms, kind="stable")
    return rows[order], terms[order], weights[order]


def _dense(height: int, rows: np.ndarray, weights: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Matrix with one column per term."""
    matrix = np.zeros((height, len(start)))
    column = np.repeat(np.arange(len(start)), count)
    at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(len(column))
    matrix[rows[at], column] = weights[at]
    return matrix


def _dot_products(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    l_rows, l_terms, l_weights = _postings(left)
    r_rows, r_terms, r_weights = _postings(right)
    l_unique, l_start, l_count = np.unique(l_terms, return_index=True, return_counts=True)
    r_unique, r_start, r_count = np.unique(r_terms, return_index=True, return_counts=True)
    _, l_at, r_at = np.intersect1d(l_unique, r_unique, assume_unique=True, return_indices=True)
    l_start, l_count, r_start, r_count = l_start[l_at], l_count[l_at], r_start[r_at], r_count[r_at]

    dots = np.zeros((len(left), len(right)))
    products = l_count * r_count
    many = np.flatnonzero(products >= _MANY)
    for first in range(0, len(many), _DENSE_COLUMNS):
        columns = many[first:first + _DENSE_COLUMNS]
        dots += _dense(len(left), l_rows, l_weights, l_start[columns], l_count[columns]) @ _dense(
            len(right), r_rows, r_weights, r_start[columns], r_count[columns]
        ).T

    for i in np.flatnonzero((products >= _FEW) & (products < _MANY)):
        ls, rs = slice(l_start[i], l_start[i] + l_count[i]), slice(r_start[i], r_start[i] + r_count[i])
        dots[np.ix_(l_rows[ls], r_rows[rs])] += np.outer(l_weights[ls], r_weights[rs])

    few = np.flatnonzero(products < _FEW)
    for small in np.array_split(few, 1 + int(products[few].sum()) // _PRODUCTS_AT_ONCE):
        term = np.repeat(small, products[small])
        nth = np.arange(len(term)) - np.repeat(np.cumsum(products[small]) - products[small], products[small])
        at_left = l_start[term] + nth // r_count[term]
        at_right = r_start[term] + nth % r_count[term]
        np.add.at(dots, (l_rows[at_left], r_rows[at_right]), l_weights[at_left] * r_weights[at_right])
    return dots


def _best(units: np.ndarray, x: np.ndarray, y: np.ndarray, bound: np.ndarray, top_k: int) -> pd.DataFrame:
    """Per row the ``top_k`` columns with the largest score, the smaller y first among equals.

    ``units`` are scores in millionths and y is ascending, so one integer orders both.
    """
    width = units.shape[1]
    keys = units * width + (width - 1 - np.arange(width))
    keep = min(top_k, width)
    chosen = np.argpartition(-keys, keep - 1, axis=1)[:, :keep]
    score = np.take_along_axis(units, chosen, axis=1)
    hit = (score > 0) & (score >= bound[:, None])
    row, nth = np.nonzero(hit)
    return pd.DataFrame({"x": x[row], "y": y[chosen[row, nth]], "score": score[row, nth] / _MILLION})


def _units(dots: np.ndarray) -> np.ndarray:
    return np.floor(np.minimum(dots, 1.0) * _MILLION + 0.5).astype(np.int64)


def _bound_units(block: pd.DataFrame) -> np.ndarray:
    return np.rint(block["bound"].to_numpy() * _MILLION).astype(np.int64)


def matches_within(top_k: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def find(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("v", ignore_index=True)
        dots = _dot_products(block, block)
        np.fill_diagonal(dots, 0)
        v = block["v"].to_numpy()
        return _best_reached(dots, v, v, np.zeros(len(v), dtype=np.int64), top_k)

    return find


def _best_reached(dots: np.ndarray, x: np.ndarray, y: np.ndarray, bound: np.ndarray, top_k: int) -> pd.DataFrame:
    """As ``_best`` of the rounded scores. Where few scores reach the bound of their row, only these are rounded and sorted."""
    near = dots >= ((np.maximum(bound, 1) - 0.51) / _MILLION)[:, None]
    if np.count_nonzero(near) > 2 * top_k * len(x):
        return _best(_units(dots), x, y, bound, top_k)
    row, column = np.nonzero(near)
    score = _units(dots[row, column])
    hit = score >= np.maximum(bound, 1)[row]
    row, column, score = row[hit], column[hit], score[hit]
    order = np.lexsort((column, -score, row))
    row, column, score = row[order], column[order], score[order]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    first = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)])) < top_k
    return pd.DataFrame({"x": x[row[first]], "y": y[column[first]], "score": score[first] / _MILLION})


class _Side:
    """Postings of some vectors, which are sorted by term, and where those of each term of the vocabulary are."""

    def __init__(self, height: int, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, vocabulary: int):
        self.height, self.rows, self.weights = height, rows, weights
        self.count = np.bincount(terms, minlength=vocabulary).astype(np.int32)
        self.start = (np.cumsum(self.count, dtype=np.int64) - self.count).astype(np.int32)

    def dense(self, terms: np.ndarray) -> np.ndarray:
        """Matrix with one column per term."""
        matrix = np.zeros((self.height, len(terms)), np.float32)
        count = self.count[terms]
        column = np.repeat(np.arange(len(terms)), count)
        at = np.repeat(self.start[terms] - (np.cumsum(count) - count), count) + np.arange(len(column))
        matrix[self.rows[at], column] = self.weights[at]
        return matrix


def _near_products(left: _Side, right: _Side) -> np.ndarray:
    """Dot products in single precision. Each is off by less than its own share of ``_relative_error``."""
    dots = np.zeros((left.height, right.height), np.float32)
    common = np.flatnonzero((left.count > 0) & (right.count > 0))
    l_count, r_count = left.count[common].astype(np.int64), right.count[common].astype(np.int64)
    products, least = l_count * r_count, max(_FEW, dots.size // _DENSE_SHARE)
    many = common[products >= least]
    for first in range(0, len(many), _DENSE_COLUMNS):
        columns = many[first:first + _DENSE_COLUMNS]
        dots += left.dense(columns) @ right.dense(columns).T

    for term in common[(products >= _FEW) & (products < least)]:
        ls = slice(left.start[term], left.start[term] + left.count[term])
        rs = slice(right.start[term], right.start[term] + right.count[term])
        dots[left.rows[ls][:, None], right.rows[rs]] += left.weights[ls][:, None] * right.weights[rs]

    few, flat = np.flatnonzero(products < _FEW), dots.reshape(-1)
    for small in np.array_split(few, 1 + int(products[few].sum()) // _PRODUCTS_AT_ONCE):
        term = np.repeat(small, products[small])
        nth = np.arange(len(term)) - np.repeat(np.cumsum(products[small]) - products[small], products[small])
        row = nth // r_count[term]
        at_left, at_right = left.start[common[term]] + row, right.start[common[term]] + nth - row * r_count[term]
        at = left.rows[at_left].astype(np.int64) * right.height + right.rows[at_right]
        np.add.at(flat, at, left.weights[at_left] * right.weights[at_right])
    return dots


def _relative_error(lengths: np.ndarray) -> np.ndarray:
    """Of a sum in single precision of at most so many products of numbers that are not negative, with some room."""
    return (lengths + 8) * 2.0**-23


class _Square:
    """The vectors that meet in a square, and the pairs of them that may be among the best matches."""

    def __init__(self, vectors: pd.DataFrame, top_k: int):
        self.top_k, self.v = top_k, vectors["v"].to_numpy()
        self.lengths = vectors["terms"].str.len().to_numpy()
        self.starts = np.cumsum(self.lengths) - self.lengths
        terms = np.concatenate(vectors["terms"].to_numpy())
        self.weights = np.concatenate(vectors["weights"].to_numpy())
        order = np.argsort(terms, kind="stable")
        terms = terms[order]
        terms = np.cumsum(np.r_[False, terms[1:] != terms[:-1]], dtype=np.int32)
        self.vocabulary, self.terms = int(terms[-1]) + 1, np.empty(len(terms), np.int32)
        self.terms[order] = terms
        rows = np.repeat(np.arange(len(vectors), dtype=np.int32), self.lengths)[order]
        self.by_term = rows, terms, self.weights[order].astype(np.float32)
        self.least, self.error = np.maximum(_bound_units(vectors), 1), _relative_error(self.lengths)
        self.limit = (self.least - 0.51) / _MILLION * (1 - self.error)
        self.x, self.y, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        self.sides = {}

    def _postings(self, rows: np.ndarray) -> np.ndarray:
        lengths = self.lengths[rows]
        return np.repeat(self.starts[rows] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())

    def _side(self, rows: np.ndarray) -> _Side:
        key = (rows[0], len(rows)) if rows[-1] - rows[0] == len(rows) - 1 else None
        if key in self.sides:
            return self.sides[key]
        place = np.full(len(self.v), -1, np.int32)
        place[rows] = np.arange(len(rows))
        of, terms, weights = self.by_term
        at = place[of]
        here = np.flatnonzero(at >= 0)
        side = _Side(len(rows), at[here], terms[here], weights[here], self.vocabulary)
        if key is not None:
            self.sides[key] = side
        return side

    def _raised(self, x: np.ndarray, kth: np.ndarray) -> None:
        """Nothing much below the ``top_k``-th score so far is looked for."""
        self.limit[x] = np.maximum(self.limit[x], kth * (1 - 2 * self.error[x]) - 1e-6)

    def _reached(self, dots: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = dots >= self.limit[rows].astype(np.float32)[:, None]
        crowded = np.flatnonzero(np.count_nonzero(near, axis=1) > 4 * self.top_k)
        for some in np.array_split(crowded, 1 + len(crowded) * dots.shape[1] // _SCORES_AT_ONCE):
            if len(some):
                scores = dots[some]
                self._raised(rows[some], -np.partition(-scores, self.top_k - 1, axis=1)[:, self.top_k - 1])
                near[some] = scores >= self.limit[rows[some]].astype(np.float32)[:, None]
        return np.nonzero(near)

    def meet(self, left: np.ndarray, right: np.ndarray) -> None:
        dots = _near_products(self._side(left), self._side(right))
        a, b = self._reached(dots, left)
        d, c = self._reached(dots.T, right)
        x, y = np.r_[self.x, left[a], right[d]], np.r_[self.y, right[b], left[c]]
        score = np.r_[self.score, dots[a, b], dots[c, d]]
        order = np.lexsort((-score, x))
        x, y, score = x[order], y[order], score[order]
        starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
        last = np.arange(len(x)) - np.repeat(starts, np.diff(np.r_[starts, len(x)])) == self.top_k - 1
        self._raised(x[last], score[last])
        kept = score >= self.limit[x].astype(np.float32)
        self.x, self.y, self.score = x[kept], y[kept], score[kept]

    def _exact(self) -> np.ndarray:
        """Dot products of the pairs, which are sorted by x."""
        out, weight = np.zeros(len(self.x)), np.zeros(self.vocabulary)
        cuts = np.r_[np.flatnonzero(np.r_[True, self.x[1:] != self.x[:-1]]), len(self.x)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            own = slice(self.starts[self.x[low]], self.starts[self.x[low]] + self.lengths[self.x[low]])
            weight[self.terms[own]] = self.weights[own]
            at, lengths = self._postings(self.y[low:high]), self.lengths[self.y[low:high]]
            out[low:high] = np.add.reduceat(self.weights[at] * weight[self.terms[at]], np.cumsum(lengths) - lengths)
            weight[self.terms[own]] = 0
        return out

    def best(self) -> pd.DataFrame:
        """The ``top_k`` best matches of each vector that reach its bound, the smaller y first among equals."""
        units = _units(self._exact()) if len(self.x) else np.zeros(0, np.int64)
        hit = units >= self.least[self.x]
        x, y, units = self.x[hit], self.v[self.y[hit]], units[hit]
        order = np.lexsort((y, -units, x))
        x, y, units = x[order], y[order], units[order]
        starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
        first = np.arange(len(x)) - np.repeat(starts, np.diff(np.r_[starts, len(x)])) < self.top_k
        return pd.DataFrame({"x": self.v[x[first]], "y": y[first], "score": units[first] / _MILLION})


def matches_in_square(top_k: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The best matches between blocks, from the vectors of some blocks with the ``blocks`` that each of them meets here.

    Scores are added up in single precision; pairs that may be among the best are added up again in double precision.
    """
    def find(vectors: pd.DataFrame) -> pd.DataFrame:
        vectors = vectors.sort_values(["block", "v"], ignore_index=True)
        square, block = _Square(vectors, top_k), vectors["block"].to_numpy()
        row = np.repeat(np.arange(len(vectors)), vectors["blocks"].str.len().to_numpy())
        other = np.concatenate(vectors["blocks"].to_numpy())
        order = np.lexsort((row, other, block[row]))
        row, other, of = row[order], other[order], block[row][order]
        cuts = np.r_[np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (other[1:] != other[:-1])]), len(row)]
        meets = {(of[low], other[low]): row[low:high] for low, high in zip(cuts[:-1], cuts[1:])}
        for low, high in meets:
            if low < high and (high, low) in meets:
                square.meet(meets[low, high], meets[high, low])
        return square.best()

    return find


def topic_centers(vectors: np.ndarray, topics: int, rounds: int = 10) -> np.ndarray:
    """Directions of so many groups of vectors, by spherical k-means."""
    unit = lambda rows: rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    vectors = unit(vectors)
    centers = vectors[np.linspace(0, len(vectors) - 1, min(topics, len(vectors))).astype(int)]
    for _ in range(rounds):
        nearest = (vectors @ centers.T).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, vectors)
        centers = unit(np.where(np.bincount(nearest, minlength=len(centers))[:, None] > 0, sums, centers))
    return centers


def with_topics(known: np.ndarray, centers: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Appends the ``topic`` of each vector: the nearest center by the terms ``known``, which are sorted."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, _ROWS_AT_ONCE):
                batch = whole.slice(first, _ROWS_AT_ONCE)
                lengths = batch["terms"].value_lengths().to_numpy()
                rows, terms = np.repeat(np.arange(batch.num_rows), lengths), batch["terms"].flatten().to_numpy()
                at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
                held = known[at] == terms
                dense = np.zeros((batch.num_rows, len(known)), np.float32)
                dense[rows[held], at[held]] = batch["weights"].flatten().to_numpy()[held]
                topic = pa.array((dense @ centers.T).argmax(1).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*batch.columns, topic], names=[*batch.schema.names, "topic"])

    return find


# Upper bounds are summed in single precision and compared with scores of six decimals.
_SLACK, _ROUNDING = 2e-6, 1e-5
_POSTINGS_AT_ONCE = 100_000
_COLUMNS_AT_ONCE = 64


def _sums(rows: np.ndarray, height: int, terms: np.ndarray, weights: np.ndarray, tops: np.ndarray) -> np.ndarray:
    """Sum of weight times top per row and column of ``tops``, with postings sorted by row."""
    out = np.zeros((height, tops.shape[1]), np.float32)
    cuts = np.r_[np.arange(0, len(rows), _POSTINGS_AT_ONCE), len(rows)]
    for low, high in zip(cuts[:-1], cuts[1:]):
        if low == high:
            continue
        products = weights[low:high, None] * tops[terms[low:high]]
        starts = np.flatnonzero(np.r_[True, rows[low + 1:high] != rows[low:high - 1]])
        out[rows[low:high][starts]] += np.add.reduceat(products, starts, axis=0)
    return out


def _columns(known: np.ndarray, term_lists: list[np.ndarray], top_lists: list[np.ndarray]) -> np.ndarray:
    """One column of maxima per list, over the terms ``known``."""
    out = np.zeros((len(known), len(term_lists)), np.float32)
    for column, (terms, tops) in enumerate(zip(term_lists, top_lists, strict=True)):
        at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
        held = known[at] == terms
        np.maximum.at(out[:, column], at[held], tops[held].astype(np.float32))
    return out


def _heavy_part(rows: np.ndarray, weights: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which postings come before the lighter rest whose length is at most half the bound, and that length per row.

    A unit vector gains at most the length of the rest from it, whatever the terms. Postings are heaviest first.
    """
    squares = weights.astype(np.float64) ** 2
    ends = np.r_[np.flatnonzero(rows[1:] != rows[:-1]), len(rows) - 1]
    before = np.cumsum(squares) - squares
    total = np.zeros(len(bound))
    total[rows[ends]] = before[ends] + squares[ends]
    rest = np.sqrt(np.maximum(total[rows] - before, 0))
    heavy = rest > bound[rows] / 2
    length = np.zeros(len(bound))
    np.maximum.at(length, rows[~heavy], rest[~heavy])
    return heavy, length


def _reached(sums: np.ndarray, bound: np.ndarray) -> np.ndarray:
    return (sums > 0) & (sums * (1 + _ROUNDING) + _SLACK >= bound[:, None])


def asked_cells(vectors: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Which vectors of a block may find a better match in which cells of other blocks.

    Bounds are taken over whole blocks first, then over the cells of a block for the vectors that reached it.
    """
    empty = pd.DataFrame({"block": [], "v": [], "cell": [], "others": []}, dtype=object)
    if vectors.empty or index.empty:
        return empty
    block = int(vectors["block"].iloc[0])
    lengths = vectors["terms"].str.len().to_numpy()
    rows = np.repeat(np.arange(len(vectors)), lengths)
    known, terms = np.unique(np.concatenate(vectors["terms"].to_numpy()), return_inverse=True)
    weights = np.concatenate(vectors["weights"].to_numpy()).astype(np.float32)
    bound, partners = vectors["bound"].to_numpy(), [[] for _ in range(len(vectors))]
    heavy, rest = _heavy_part(rows, weights, bound)
    out = []
    for other, cells in index.groupby("block"):
        whole = _columns(known, [np.concatenate(cells["terms"].to_numpy())], [np.concatenate(cells["tops"].to_numpy())])
        upper = np.minimum(
            _sums(rows, len(vectors), terms, weights, whole),
            _sums(rows[heavy], len(vectors), terms[heavy], weights[heavy], whole) + rest[:, None],
        )
        asking = np.flatnonzero(_reached(upper, bound)[:, 0])
        if not len(asking):
            continue
        chosen = np.isin(rows, asking)
        place = np.searchsorted(asking, rows[chosen])
        asked = np.zeros(len(asking), bool)
        for low in range(0, len(cells), _COLUMNS_AT_ONCE):
            part = cells.iloc[low:low + _COLUMNS_AT_ONCE]
            tops = _columns(known, list(part["terms"]), list(part["tops"]))
            reached = _reached(_sums(place, len(asking), terms[chosen], weights[chosen], tops), bound[asking])
            asked |= reached.any(1)
            out += [(int(other), None, int(cell), [block]) for cell in part["cell"].to_numpy()[reached.any(0)]]
        for row in asking[asked]:
            partners[row].append(int(other))
    names = vectors["v"].to_numpy()
    out += [(block, int(names[row]), None, others) for row, others in enumerate(partners) if others]
    if not out:
        return empty
    found = pd.DataFrame(out, columns=["block", "v", "cell", "others"])
    return found.astype({"v": "Int64", "cell": "Int32"})


def asked_by_blocks(vectors: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """``asked_cells`` of each block among the vectors, in the cells of all other blocks."""
    return pd.concat([asked_cells(own, index[index["block"] != block]) for block, own in vectors.groupby("block")] or [
        asked_cells(vectors, index)
    ])
