"""Language-model scores from a probabilistic suffix tree, beside a smoothed unigram score.

Symbols are the bytes of lower-cased words; a word ends with a space, a text with a line feed. The context of a byte is
what stands before it, at most ``DEPTH`` bytes: in the model of texts (``across_words``) it reaches over words back to
the start of the text, which counts as line feeds; in the model of words to the space before its word. A context of the
tree

* occurs before at least ``LEAST_SHARE`` of all symbols, so there are at most ``DEPTH / LEAST_SHARE`` of them, and
* passes a divergence test: its distribution explains the symbols after it better than that of the context
  without its oldest byte, by ``LEAST_GAIN`` nats over all of them; or a longer context does that extends it.

Its distribution is smoothed towards the shorter context, down to the root, which adds one to every symbol. A
symbol is scored in the longest context of the tree that ends before it.

Plan of the model of texts: tasks lay texts out as symbols in chunks of bounded size. A first pass finds the contexts
that can have the least share: a chunk passes on those above ``CHUNK_SHARE`` of it there, so that what all chunks leave
out of a count is less than ``CHUNK_SHARE`` of the least count, and at most ``DEPTH / (1 - CHUNK_SHARE) / LEAST_SHARE``
contexts are left. A second pass counts these exactly, each symbol in its longest one. The tree goes to every task and
scores whole texts there.

Plan of the model of words: the probability of a word does not depend on its neighbours, so the tree learns from the
distinct words and their counts, and each distinct word is scored once.

The unigram score needs word counts in both (combined in every task before the shuffle). What is known by word returns to
the texts in two ways: the ``FREQUENT`` most frequent words go to every task as a lookup of bounded size, which also
takes the hot words out of the join; all other (text, word) rows are joined.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import LOWER, UPPER, batches, small_batches
from marquee.session import materialize

FOLDS = 7
HELD_FOLD = 2
DEPTH = 6
LEAST_SHARE = 1e-5
LEAST_GAIN = 20.0
PRIOR = 8.0
FREQUENT = 100_000
HELD_WORDS = 300_000  # distinct words that a task holds before it hands their counts on
CHUNK_SYMBOLS = 1 << 21  # symbols that a task looks at together
CHUNK_SHARE = 0.25
LOOKED_UP = 1 << 16  # symbols whose contexts are looked up together, so that what is made on the way stays in the caches
HELD_GRAMS = 1_000_000  # distinct contexts that a task holds before it hands their counts on

SPACE, END = 0x20, 0x0A
_SYMBOLS = 256
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def held_out(key: str):
    """True for the documents of the held-out fold; documents without a key are learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


def word_counts(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(word, n): every word of all texts and how often the texts to learn from hold it, 0 included. The end of a
    text is the word ''."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(parts):
        def rows():
            learned: Counter[bytes] = Counter()
            others: set[bytes] = set()
            for part in parts:
                for held, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    words = words_of(text.as_py())
                    if held:
                        others.update(words)
                        others.add(b"")
                    else:
                        learned.update(words)
                        learned[b""] += 1
                if len(learned) + len(others) >= HELD_WORDS:
                    yield from learned.items()
                    yield from ((word, 0) for word in others if word not in learned)
                    learned, others = Counter(), set()
            yield from learned.items()
            yield from ((word, 0) for word in others if word not in learned)

        yield from batches(schema, rows(), size=20_000)

    small_batches(docs)
    partial = docs.select(held_out(key), "text").mapInArrow(run, "word binary, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Streams:
    """Words laid out as symbols: for every symbol its context of up to ``depth`` bytes, packed, and its length."""

    context: np.ndarray
    length: np.ndarray
    symbol: np.ndarray
    word: np.ndarray


def streams(words: list[bytes], depth: int = DEPTH) -> Streams:
    """Every word gives its bytes and a space; the empty word, the end of a text, gives a line feed."""
    raw = b"".join(b" " + (word + b" " if word else b"\n") for word in words)
    flat = np.frombuffer(raw, np.uint8).astype(np.int64)
    sizes = np.fromiter((len(word) + 2 if word else 2 for word in words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    offset = np.arange(len(flat)) - np.repeat(starts, sizes)
    length = np.minimum(offset, depth)
    context = np.zeros(len(flat), np.int64)
    for k in range(1, depth + 1):
        shifted = np.zeros_like(flat)
        shifted[k:] = flat[:-k]
        context |= np.where(length >= k, shifted << 8 * (k - 1), 0)
    inner = offset > 0
    number = np.repeat(np.arange(len(words)), sizes)
    return Streams(context[inner], length[inner], flat[inner], number[inner])


def context_counts(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(length, context, symbol, n) for contexts of every length up to ``depth``, from (word, n)."""
    schema = pa.schema([("length", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(parts):
        for part in parts:
            found = streams(part.column(0).to_pylist(), depth)
            weight = part.column(1).to_numpy()[found.word]
            grams, place = np.unique(found.context << 8 | found.symbol | found.length << 56, return_inverse=True)
            total = np.zeros(len(grams), np.int64)
            np.add.at(total, place, weight)
            yield pa.RecordBatch.from_arrays(
                [pa.array((grams >> 56).astype(np.int32)), pa.array(grams & (1 << 56) - 1), pa.array(total)], schema=schema
            )

    counts.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    return _with_shorter(counts.filter("n > 0").select("word", "n").mapInArrow(run, "length int, gram bigint, n bigint"))


def _with_shorter(grams: DataFrame) -> DataFrame:
    """(length, context, symbol, n) from (length, gram, n), where a gram counts for its context and all suffixes of it."""
    longest = grams.groupBy("length", "gram").agg(F.sum("n").alias("n"))
    every = longest.select("gram", "n", F.explode(F.sequence(F.lit(0), "length")).alias("length")).select(
        "length", F.expr("gram & (shiftleft(1L, 8 * (length + 1)) - 1)").alias("gram"), "n"
    )
    summed = every.groupBy("length", "gram").agg(F.sum("n").alias("n"))
    return summed.select(
        "length", F.expr("shiftright(gram, 8)").alias("context"), F.expr("gram & 255").alias("symbol"), "n"
    )


@dataclass
class Symbols:
    """Symbols of texts, each with its context of ``depth`` bytes, the nearest byte lowest, and the number of its text."""

    context: np.ndarray
    symbol: np.ndarray
    text: np.ndarray


def line_of(text: str | None) -> bytes:
    """All symbols of a text: its words, a space after each, and a line feed."""
    return b" ".join([*words_of(text), b"\n"])


def text_symbols(lines: Iterable[bytes], depth: int = DEPTH, most: int = CHUNK_SYMBOLS) -> Iterator[Symbols]:
    """The symbols of texts in chunks of about ``most``, long texts in pieces."""
    held, numbers, size = [], [], 0
    for number, line in enumerate(lines):
        line = b"\n" * depth + line
        for at in range(0, len(line) - depth, most):
            held.append(line[at:at + depth + most])
            numbers.append(number)
            size += len(held[-1])
            if size >= most:
                yield _laid_out(held, numbers, depth)
                held, numbers, size = [], [], 0
    if held:
        yield _laid_out(held, numbers, depth)


def _laid_out(pieces: list[bytes], numbers: list[int], depth: int) -> Symbols:
    """Pieces side by side; the first ``depth`` bytes of each are context only."""
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    starts = np.cumsum(sizes) - sizes
    inner = np.ones(len(raw), bool)
    for k in range(depth):
        inner[starts + k] = False
    at = np.flatnonzero(inner)
    context = np.zeros(len(at), np.int64)
    for k in range(1, depth + 1):
        context |= raw[at - k].astype(np.int64) << 8 * (k - 1)
    return Symbols(context, raw[at].astype(np.int64), np.repeat(np.array(numbers), sizes - depth))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def _counted_in_tasks(docs: DataFrame, depth: int, count) -> DataFrame:
    """(length, gram, n): what ``count`` finds in chunks of symbols, as (keys, counts) with the length in the highest byte
    of a key, summed within the tasks."""
    schema = pa.schema([("length", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(parts):
        def summed():
            lines = (line_of(text.as_py()) for part in parts for text in part.column(0))
            keys, counts, held, settled = [], [], 0, 0
            for chunk in text_symbols(lines, depth):
                key, n = count(chunk)
                keys.append(key)
                counts.append(n)
                held += len(key)
                if held >= 2 * settled + CHUNK_SYMBOLS:
                    key, n = _summed(keys, counts)
                    keys, counts, held, settled = [key], [n], len(key), len(key)
                    if settled >= HELD_GRAMS:
                        yield key, n
                        keys, counts, held, settled = [], [], 0, 0
            if keys:
                yield _summed(keys, counts)

        for key, n in summed():
            for at in range(0, len(key), 100_000):
                some = key[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((some >> 56).astype(np.int32)), pa.array(some & (1 << 56) - 1), pa.array(n[at:at + 100_000])],
                    schema=schema,
                )

    small_batches(docs)
    return docs.select("text").mapInArrow(run, "length int, gram bigint, n bigint")


def _often_in_chunk(chunk: Symbols, depth: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Contexts that stand before at least a share of the chunk's symbols, keyed by length and context, with their counts."""
    nearest_first = np.sort(chunk.context.astype(np.uint64).byteswap())  # contexts of every length are neighbours
    size = len(nearest_first)
    keys, counts = [np.zeros(1, np.int64)], [np.array([size])]
    for k in range(1, depth + 1):
        rest = np.uint64(64 - 8 * k)
        start = nearest_first >> rest
        first = np.flatnonzero(np.r_[True, start[1:] != start[:-1]])
        n = np.diff(np.r_[first, size])
        often = n >= least * size
        keys.append((start[first[often]] << rest).byteswap().astype(np.int64) | k << 56)
        counts.append(n[often])
    return np.concatenate(keys), np.concatenate(counts)


def text_context_counts(docs: DataFrame, key: str, depth: int = DEPTH, least_share: float = LEAST_SHARE) -> DataFrame:
    """(length, context, symbol, n) of the texts to learn from, complete for all contexts of the least share."""
    learned = docs.filter(~held_out(key))
    local = _counted_in_tasks(learned, depth, lambda chunk: _often_in_chunk(chunk, depth, CHUNK_SHARE * least_share))
    known = materialize(local.groupBy("length", "gram").agg(F.sum("n").alias("n")), "often-in-chunks")
    symbols = known.filter("length = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # A little below 1 - CHUNK_SHARE, for rounding.
    possible = known.filter((F.col("n") >= (0.99 - CHUNK_SHARE) * least_share * symbols) & (F.col("length") > 0)).select(
        F.expr("shiftleft(CAST(length AS BIGINT), 56) | gram").alias("key")
    )
    shared = docs.sparkSession.sparkContext.broadcast(Contexts(np.sort(possible.toArrow().column(0).to_numpy())))

    def count(chunk: Symbols):
        contexts = shared.value
        nearest_first = np.sort(chunk.context.astype(np.uint64).byteswap() | chunk.symbol.astype(np.uint64))
        first = np.flatnonzero(np.r_[True, nearest_first[1:] != nearest_first[:-1]])
        n, grams = np.diff(np.r_[first, len(nearest_first)]), nearest_first[first]
        context, symbol = (grams & ~np.uint64(255)).byteswap().astype(np.int64), (grams & np.uint64(255)).astype(np.int64)
        places = range(0, len(grams), LOOKED_UP)
        longest = np.concatenate([contexts.longest(context[at:at + LOOKED_UP], depth) for at in places])
        found = np.r_[0, contexts.keys][longest]
        return _summed([found >> 56 << 56 | (found & (1 << 56) - 1) << 8 | symbol], [n])

    return _with_shorter(_counted_in_tasks(learned, depth, count))


class Places:
    """The place of each key in an array of distinct keys, by hashing. Keys are not negative."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self._shift, self._last = np.uint64(64 - bits), (1 << bits) - 1
        self._slots, self._places = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        open_ = np.arange(len(keys))
        at = self._first_slot(keys)
        while len(open_):
            free = self._slots[at] < 0
            self._slots[at[free]] = keys[open_[free]]  # of several keys for a slot the last one gets it
            placed = self._slots[at] == keys[open_]
            self._places[at[placed]] = open_[placed]
            open_, at = open_[~placed], at[~placed] + 1 & self._last

    def _first_slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).view(np.int64)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Places of the wanted keys, -1 for those that are not there."""
        at = self._first_slot(wanted)
        there = self._slots.take(at)
        found = self._places.take(at)  # -1 in empty slots
        open_ = np.flatnonzero((there != wanted) & (there >= 0))
        at = at[open_]
        found[open_] = -1
        while len(open_):
            at = at + 1 & self._last
            there = self._slots[at]
            hit = there == wanted[open_]
            found[open_[hit]] = self._places[at[hit]]
            more = ~hit & (there >= 0)
            open_, at = open_[more], at[more]
        return found


@dataclass
class Contexts:
    """Contexts with all their suffixes, keyed by length and context. They are numbered from 1 on by their order in ``keys``;
    0 is the empty context."""

    keys: np.ndarray

    @functools.cached_property
    def _places(self) -> Places:
        return Places(self.keys)

    @functools.cached_property
    def _of_two(self) -> tuple[np.ndarray, np.ndarray]:
        """For every two bytes the longest context at their end, and those that are contexts whole."""
        best = self._extended(np.arange(1 << 16), np.zeros(1 << 16, np.int64), np.arange(1 << 16), 1, 2)
        return best, np.r_[0, self.keys][best] >> 56 == 2

    def longest(self, context: np.ndarray, depth: int) -> np.ndarray:
        """The longest of these contexts at the end of each given one."""
        if depth < 2:
            return self._extended(context, np.zeros(len(context), np.int64), np.arange(len(context)), 1, depth)
        best, whole = self._of_two
        last = context & 0xFFFF
        return self._extended(context, best[last], np.flatnonzero(whole[last]), 3, depth)

    def _extended(self, context: np.ndarray, best: np.ndarray, open_: np.ndarray, least: int, most: int) -> np.ndarray:
        for k in range(least, most + 1):
            at = self._places.find(context.take(open_) & (1 << 8 * k) - 1 | k << 56)
            there = np.flatnonzero(at >= 0)
            open_ = open_.take(there)
            best[open_] = at.take(there) + 1
        return best


@dataclass
class SuffixTree:
    """States in arrays; state 0 is the root. ``contexts`` are those of the states from 1 on."""

    depth: int
    contexts: Contexts
    parent: np.ndarray
    backoff: np.ndarray
    pairs: np.ndarray
    scores: np.ndarray

    @functools.cached_property
    def _pairs(self) -> Places:
        return Places(self.pairs)

    def _symbol_scores(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Natural logarithms of the symbols' probabilities after the states, which are changed."""
        at = self._pairs.find(state << 8 | symbol)
        score, open_ = self.scores[at], np.flatnonzero(at < 0)
        score[open_] = 0.0
        while len(open_):
            shorter = state[open_]
            score[open_] += self.backoff[shorter]
            state[open_] = self.parent[shorter]
            at = self._pairs.find(state[open_] << 8 | symbol[open_])
            hit = at >= 0
            score[open_[hit]] += self.scores[at[hit]]
            open_ = open_[~hit]
        return score

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word with its end, by itself."""
        found = streams(words, self.depth)
        state = np.zeros(len(found.symbol), np.int64)
        for length in range(1, self.depth + 1):
            some = np.flatnonzero(found.length == length)
            state[some] = self.contexts.longest(found.context[some], length)
        return np.bincount(found.word, self._symbol_scores(state, found.symbol), len(words)) / math.log(10)

    def text_scores(self, lines: list[bytes]) -> np.ndarray:
        """log10 probability of each text, given as all its symbols."""
        total = np.zeros(len(lines))
        for chunk in text_symbols(lines, self.depth, LOOKED_UP):
            state = self.contexts.longest(chunk.context, self.depth)
            total += np.bincount(chunk.text, self._symbol_scores(state, chunk.symbol), len(lines))
        return total / math.log(10)


def grow_tree(length: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray, depth: int = DEPTH,
              least_gain: float = LEAST_GAIN, prior: float = PRIOR) -> SuffixTree:
    """Test and smooth the contexts that occur often enough; every context comes with all its suffixes."""
    key = length << 56 | context
    order = np.lexsort((symbol, key))
    key, symbol, n = key[order], symbol[order], n[order]
    keys, of = np.unique(np.r_[0, key], return_inverse=True)  # the root is first, also where nothing was learned
    of = of[1:]
    size = np.bincount(of, n, len(keys))
    long = keys >> 56
    shorter = np.searchsorted(keys, np.where(long > 0, long - 1 << 56 | keys & (1 << 8 * np.maximum(long - 1, 0)) - 1, 0))
    row = of << 8 | symbol
    base = np.searchsorted(row, shorter[of] << 8 | symbol)  # what follows a context follows its suffixes
    gain = np.bincount(of, n * np.log(n / size[of] * size[shorter[of]] / n[base]), len(keys))
    kept = gain >= least_gain
    kept[0] = True
    for k in range(depth, 0, -1):
        kept[shorter[kept & (long == k)]] = True

    probability = (n + 1) / (size[of] + _SYMBOLS)
    for k in range(1, depth + 1):
        some = np.flatnonzero(long[of] == k)
        probability[some] = (n[some] + prior * probability[base[some]]) / (size[of[some]] + prior)
    root = np.full(_SYMBOLS, 1 / (size[0] + _SYMBOLS))
    root[symbol[of == 0]] = probability[of == 0]
    state = np.cumsum(kept) - 1
    inner = kept[of] & (of > 0)
    backoff = np.log(prior / (size[kept] + prior))
    backoff[0] = 0.0
    return SuffixTree(
        depth, Contexts(keys[kept][1:]), state[shorter[kept]], backoff,
        np.r_[np.arange(_SYMBOLS), state[of[inner]] << 8 | symbol[inner]], np.log(np.r_[root, probability[inner]]),
    )


def fit_tree(counts: DataFrame, depth: int = DEPTH, least_share: float = LEAST_SHARE, **options) -> SuffixTree:
    """The tree from (length, context, symbol, n). Only contexts above the least share reach the driver, at most
    depth / share."""
    grams = materialize(counts, "contexts")
    symbols = grams.filter("length = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = (
        grams.groupBy("length", "context").agg(F.sum("n").alias("size"))
        .filter((F.col("size") >= F.lit(least_share * symbols)) | (F.col("length") == 0)).drop("size")
    )
    rows = grams.join(often, ["length", "context"]).toArrow()
    columns = (rows[name].to_numpy().astype(np.int64) for name in ("length", "context", "symbol", "n"))
    return grow_tree(*columns, depth=depth, **options)


def scored_words(counts: DataFrame, tree: SuffixTree) -> DataFrame:
    """(word, n, score) with the tree's log10 probability."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64()), ("score", pa.float64())])
    shared = counts.sparkSession.sparkContext.broadcast(tree)

    def run(parts):
        for part in parts:
            values = shared.value.word_scores(part.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(values)], schema=schema)

    counts.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    return counts.select("word", "n").mapInArrow(run, "word binary, n bigint, score double")


def frequent_words(words: DataFrame, most: int) -> list:
    """The most frequent words, at most ``most`` of them: all down to a level of counts that is found from the
    number of words at each level (a row per hundredth of a power of e)."""
    level = F.floor(F.ln(F.col("n").cast("double")) * 100)
    levels = words.filter("n > 0").groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()
    lowest, held = None, 0
    for row in sorted(levels, key=lambda r: -r["level"]):
        held += row["words"]
        if held > most:
            break
        lowest = row["level"]
    return [] if lowest is None else words.filter((F.col("n") > 0) & (level >= lowest)).collect()


def _text_rows(
    docs: DataFrame, key: str, frequent: dict[bytes, tuple[int, float, float]], tree: SuffixTree | None = None
) -> DataFrame:
    """A row per text with the sums over its frequent words, and a row per text and other word. A ``tree`` adds the score
    of the whole text."""
    schema = pa.schema([
        ("row_no", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64()), ("word", pa.binary()), ("times", pa.int64()),
    ])
    shared = docs.sparkSession.sparkContext.broadcast((frequent, tree))

    def run(parts):
        def rows():
            lookup, tree = shared.value
            row = TaskContext.get().partitionId() << 40
            for part in parts:
                own = [0.0] * len(part)
                if tree is not None:
                    own = tree.text_scores([line_of(text.as_py()) for text in part.column(2)]).tolist()
                columns = part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), own
                for one, held, text, score in zip(*columns, strict=True):
                    words = words_of(text.as_py())
                    words.append(b"")
                    known, base = 0, 0.0
                    for word, times in Counter(words).items():
                        entry = lookup.get(word)
                        if entry is None:
                            yield row, None, None, None, None, None, None, word, times
                        else:
                            known += times * (entry[0] > 0)
                            base += times * entry[1]
                            score += times * entry[2]
                    # A key that no word equals keeps this row out of the join's hot spots.
                    yield row, one, held, len(words), known, base, score, b"\n%d" % row, None
                    row += 1

        yield from batches(schema, rows(), size=20_000)

    small_batches(docs)
    return docs.select(F.col(key).cast("long"), held_out(key), "text").mapInArrow(
        run, "row_no bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, "
        "score double, word binary, times bigint"
    )


def score_texts(
    docs: DataFrame, key: str = "doc_id", depth: int = DEPTH, least_share: float = LEAST_SHARE, frequent: int = FREQUENT,
    across_words: bool = False, **options,
) -> DataFrame:
    """Score every whole text; learn from those outside the held-out fold.

    Returns the key, held_out, n_tokens, n_known, train_tokens, base_score and score. Tokens are the lower-cased
    words and the end; a null text is empty and has the end alone. ``base_score`` adds one to every count, ``score``
    is the suffix tree's log10 probability, of the text with ``across_words``, else of its words one by one. Rows are scored one by one, so repeated keys give repeated rows; every
    row, a repeated one too, counts in the training. With nothing to learn from, all counts are 0 and the tree is
    its uniform root. Other columns are ignored; no rows give no rows.
    """
    counts = materialize(word_counts(docs, key), "word-counts")
    tokens, types = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0))
    ).first()
    if across_words:
        tree = fit_tree(text_context_counts(docs, key, depth, least_share), depth, least_share, **options)
        scored = counts.withColumn("score", F.lit(0.0))
    else:
        tree = fit_tree(context_counts(counts, depth), depth, least_share, **options)
        scored = scored_words(counts, tree)
    scored = scored.withColumn(
        "base", F.log10((F.col("n") + 1).cast("double") / F.lit(float(tokens + types + 1)))
    )
    words = materialize(scored, "word-scores")
    lookup = {bytes(row["word"]): (row["n"], row["base"], row["score"]) for row in frequent_words(words, frequent)}
    other = words.select("word", F.col("n").alias("count"), "base", F.col("score").alias("own"))
    joined = _text_rows(docs, key, lookup, tree if across_words else None).join(other, "word", "left")
    plus = lambda name, extra: (F.sum(F.coalesce(F.col(name), extra))).alias(name)
    return (
        joined.groupBy("row_no").agg(
            F.max("doc_id").alias(key), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
            plus("n_known", F.when(F.col("count") > 0, F.col("times")).otherwise(0)),
            plus("base_score", F.col("times") * F.col("base")), plus("score", F.col("times") * F.col("own")),
        )
        .select(
            key, "held_out", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"),
            "base_score", "score",
        )
    )
