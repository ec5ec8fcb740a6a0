"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A unit (a run of spaces with the word after it) starts as characters. The agenda holds the candidate merges, the
best piece first and the leftmost of equals; each is looked up once, and with probability ``dropout`` it is skipped.
The choice is a keyed hash of the seed, the document, its copy, the number of the unit in the document, the place where
the piece would start and the piece, so a run can be repeated exactly, no random state is shared, and every occurrence
of a word is cut by itself. With dropout 0 the result is the model's own segmentation.

Most occurrences skip no merge that counts. A worker keeps, for every unit it has met, the merges of its run without
dropout and the pieces these leave: the hashes of those merges are computed for all occurrences at once, and where none
is skipped the kept pieces stand. The other occurrences run the agenda, many at a time: all of one length advance
together, each by its own best merge; long units go through a heap.

Decoding gathers the bytes of the pieces. A space is written with the model's mark; a mark that is itself in a text, and
every character without a piece, is written as byte pieces, so every text comes back exactly.

Plan: one pass over the texts in the tasks that read them, no shuffle. The model file travels as a broadcast of its
bytes; it is read where the driver runs.
"""

from __future__ import annotations

import heapq
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20_26
HELD_BYTES = 96 << 20  # of the units, merges and pieces that a worker keeps
LONG_UNIT = 40  # longer units are neither kept nor cut together
SLICE_CHARS = 1 << 20
MARK = "▁"

_SHIFT = 22
_CHARS = 1 << 20  # symbols from here on are characters without a piece
_MASK = (1 << 64) - 1
# The constants of a public 64-bit mixer.
_ODD, _MIX_1, _MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(x: int) -> int:
    x = (x + _ODD) & _MASK
    x = (x ^ x >> 30) * _MIX_1 & _MASK
    x = (x ^ x >> 27) * _MIX_2 & _MASK
    return x ^ x >> 31


def _mixed_array(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(_ODD)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX_2)
    return x ^ (x >> np.uint64(31))


class PieceModel:
    """The vocabulary and merges of a model, with the segmentation of units."""

    def __init__(self, raw: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_proto=raw)
        self.size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(self.size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(self.size)]
        self.byte_ids = [0] * 256
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
        self.ids = {piece: i for i, piece in enumerate(self.pieces) if not special[i]}
        self.table = [
            bytes([int(p[3:-1], 16)]) if model.is_byte(i) else b"" if special[i] else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.piece_bytes = np.frombuffer(b"".join(self.table), np.uint8)
        self.piece_size = np.array([len(piece) for piece in self.table], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.byte_id = np.array(self.byte_ids, np.int32)
        self.symbols = np.arange(_CHARS, _CHARS + 0x110000, dtype=np.int64)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        merges = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self._symbol(piece[:cut]), self._symbol(piece[cut:])
                if left is not None and right is not None:
                    merges[left << _SHIFT | right] = i
        self.merges = merges
        score = np.array([model.get_score(i) for i in range(self.size)])
        self.score = score.tolist()
        # Rank of a piece among the scores, equal ones alike; the entry after the last piece stands for no merge.
        self.rank = np.r_[np.unique(-score, return_inverse=True)[1], np.iinfo(np.int32).max].astype(np.int32)
        self._index(merges)
        inside = {c for piece in self.ids if len(piece) > 1 for c in piece}
        alone = "".join(re.escape(c) for c in "\n\t\r" if c not in inside)
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            self.unit = re.compile("(?s).+")
        else:
            self.unit = re.compile(f"[{alone}]|{MARK}*[^{MARK}{alone}]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+")

    def _symbol(self, piece: str) -> int | None:
        return self.ids.get(piece, _CHARS + ord(piece) if len(piece) == 1 else None)

    def slices(self, text: str):
        """Parts of a text, each with whether a literal mark follows it; spaces are marks, the first has one more."""
        first = True
        for n, segment in enumerate(text.split(MARK)):
            if n:
                yield None
            segment = (MARK if first else "") + segment.replace(" ", MARK)
            first, at = False, 0
            while at < len(segment):
                end = at + SLICE_CHARS
                while end < len(segment) and not (segment[end] == MARK and segment[end - 1] != MARK):
                    end += 1
                yield segment[at:end]
                at = end

    def units(self, text: str) -> list[str]:
        """Units of a text in order; '' stands for a literal mark."""
        found: list[str] = []
        for part in self.slices(text) if text else ():
            found.extend([""] if part is None else self.unit.findall(part))
        return found

    def _expanded(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of symbols and their new sizes; characters without a piece become the pieces of their bytes."""
        rest = np.flatnonzero(symbols >= _CHARS)
        if not len(rest):
            return symbols.astype(np.int32), sizes
        raw = [chr(c - _CHARS).encode("utf-8", "surrogatepass") for c in symbols[rest].tolist()]
        width = np.ones(len(symbols), np.int64)
        width[rest] = [len(one) for one in raw]
        ids = np.repeat(symbols, width)
        ids[np.repeat(symbols >= _CHARS, width)] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        ends = np.r_[0, np.cumsum(width)][np.r_[0, np.cumsum(sizes)]]
        return ids.astype(np.int32), np.diff(ends)

    def agenda(self, unit: str, seed: int, dropout: float) -> list[int]:
        """One unit through a heap of candidate merges, as ids."""
        if not unit:
            return [self.byte_ids[b] for b in MARK.encode()]
        limit = int(dropout * 2.0 ** 53)
        symbols = [int(self.symbols[ord(c)]) for c in unit]
        n = len(symbols)
        right, left, place = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(n))
        heap: list[tuple] = []

        def offer(i: int) -> None:
            j = right[i]
            if i < 0 or j >= n:
                return
            piece = self.merges.get(symbols[i] << _SHIFT | symbols[j])
            if piece is not None:
                heapq.heappush(heap, (-self.score[piece], place[i], i, j, symbols[i], symbols[j], piece))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, at, i, j, a, b, piece = heapq.heappop(heap)
            if symbols[i] != a or symbols[j] != b or right[i] != j:
                continue
            if mixed(seed ^ (at << 32 | piece)) >> 11 < limit:
                continue
            symbols[i], symbols[j] = piece, -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        kept = np.array([s for s in symbols if s >= 0], np.int64)
        return self._expanded(kept, np.array([len(kept)]))[0].tolist()

    def _index(self, merges: dict[int, int]) -> None:
        """An open table of the merges, an eighth full, for lookups of whole arrays."""
        bits = max(8, (8 * len(merges)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots, self.slot_piece = np.full(1 << bits, -1, np.int64), np.full(1 << bits, self.size, np.int32)
        for key, piece in merges.items():
            at = (key * _ODD & _MASK) >> 64 - bits
            while self.slots[at] >= 0:
                at = (at + 1) % len(self.slots)
            self.slots[at], self.slot_piece[at] = key, piece

    def _candidates(self, left, right, place, seed, limit):
        """Pieces that symbol pairs merge to; ``size`` where there is none or the merge is skipped."""
        wanted = left.astype(np.int64) << _SHIFT | right
        at = (wanted.view(np.uint64) * np.uint64(_ODD) >> self.shift).view(np.int64)
        held = self.slots[at]
        piece = np.where(held == wanted, self.slot_piece[at], np.int32(self.size))
        rest = np.flatnonzero((held != wanted) & (held >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) % len(self.slots)
            held = self.slots[at[rest]]
            hit = held == wanted[rest]
            piece[rest[hit]] = self.slot_piece[at[rest[hit]]]
            rest = rest[~hit & (held >= 0)]
        if limit:
            found = np.flatnonzero(piece < self.size)
            where = place[found].astype(np.uint64) << np.uint64(32) | piece[found].astype(np.uint64)
            chance = _mixed_array(seed[found] ^ where) >> np.uint64(11)
            piece[found[chance < np.uint64(limit)]] = self.size
        return piece

    def _same_length(self, units: list[str], seed: np.ndarray, dropout: float, trace: list | None = None):
        """(symbols, sizes) of units of one length, all at once: in every round each unit makes its best merge or is
        finished. ``trace`` is given (unit numbers, place and piece of the merge) of every round."""
        width, limit = len(units[0]), int(dropout * 2.0 ** 53)
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, width)
        symbols = self.symbols[points]
        place = np.broadcast_to(np.arange(width, dtype=np.int8), symbols.shape).copy()
        rows = np.arange(len(units))
        out, sizes = np.zeros((len(units), width), np.int64), np.zeros(len(units), np.int64)

        def finish(which: np.ndarray) -> None:
            out[rows[which], :symbols.shape[1]] = symbols[which]
            sizes[rows[which]] = symbols.shape[1]

        if width == 1:
            finish(rows)
            return out, sizes
        piece = self._candidates(
            symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), place[:, :-1].ravel(), np.repeat(seed, width - 1), limit
        ).reshape(-1, width - 1)
        while True:
            ranks = self.rank[piece]
            best = np.argmin(ranks, 1)
            every = np.arange(len(rows))
            new = piece[every, best]
            open_ = new < self.size
            if not open_.all():
                finish(np.flatnonzero(~open_))
                rows, symbols, place, seed = rows[open_], symbols[open_], place[open_], seed[open_]
                piece, best, new = piece[open_], best[open_], new[open_]
                every = np.arange(len(rows))
            if not len(rows):
                return out, sizes
            if trace is not None:
                trace.append((rows, place[every, best].astype(np.uint64) << np.uint64(32) | new.astype(np.uint64)))
            n, width = symbols.shape
            keep = np.ones((n, width), bool)
            keep[every, best + 1] = False
            symbols, place = symbols[keep].reshape(n, width - 1), place[keep].reshape(n, width - 1)
            symbols[every, best] = new
            if width == 2:
                finish(every)
                return out, sizes
            keep = np.ones((n, width - 1), bool)
            keep[every, best] = False
            piece = piece[keep].reshape(n, width - 2)
            for shift in (-1, 0):
                some = np.flatnonzero((best + shift >= 0) & (best + shift < width - 2))
                at = best[some] + shift
                piece[some, at] = self._candidates(
                    symbols[some, at], symbols[some, at + 1], place[some, at], seed[some], limit
                )

    def segment(self, units: list[str], seeds: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of units one after another, each under its own seed."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        order = np.argsort(lengths, kind="stable")
        parts, sizes = [], np.zeros(len(units), np.int64)
        for some in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(units) else ():
            length = lengths[some[0]]
            if length == 0 or length > LONG_UNIT:
                found = [self.agenda(units[i], int(seeds[i]), dropout) for i in some.tolist()]
                sizes[some] = [len(one) for one in found]
                parts += [np.array(one, np.int32) for one in found]
            else:
                symbols, kept = self._same_length([units[i] for i in some.tolist()], seeds[some], dropout)
                ids, sizes[some] = self._expanded(symbols[np.arange(symbols.shape[1]) < kept[:, None]], kept)
                parts.append(ids)
        # Parts stand in order of length; the gather puts them back in the order asked.
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        starts = np.zeros(len(units), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return ids[ranges(starts, sizes)], sizes

    def decode_all(self, ids: np.ndarray) -> bytes:
        """The bytes of pieces one after another."""
        return self.piece_bytes[ranges(self.piece_start[ids], self.piece_size[ids])].tobytes()

    def decode(self, ids) -> str:
        """The text of the ids of one document."""
        return self.decode_all(np.asarray(ids, np.int64)).decode("utf-8", "surrogatepass")[1:]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of the ranges (start, size), one range after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class _Grown:
    """An array that is added to."""

    def __init__(self, kind) -> None:
        self.values, self.used = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.used + len(more) > len(self.values):
            grown = np.zeros(max(2 * len(self.values), self.used + len(more)), self.values.dtype)
            grown[:self.used] = self.values[:self.used]
            self.values = grown
        self.values[self.used:self.used + len(more)] = more
        self.used += len(more)


class Store:
    """Units with their runs without dropout: the merges made and the pieces left."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.numbers: dict[str, int] = {}
        self.chars = 0
        self.merges, self.ids = _Grown(np.uint64), _Grown(np.int32)
        self.merge_start, self.merge_count, self.id_start, self.id_count = (_Grown(np.int64) for _ in range(4))

    def size(self) -> int:
        """Bytes held, about: a unit's string and its place in the dictionary, its numbers, its merges and pieces."""
        return 150 * len(self.numbers) + 4 * self.chars + 8 * self.merges.used + 4 * self.ids.used

    def add(self, units: list[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for unit in units:
            by_length.setdefault(len(unit), []).append(unit)
        for length, some in by_length.items():
            trace: list[tuple] = []
            if length:
                symbols, kept = self.model._same_length(some, np.zeros(len(some), np.uint64), 0.0, trace)
                ids, sizes = self.model._expanded(symbols[np.arange(symbols.shape[1]) < kept[:, None]], kept)
            else:
                ids = np.array(self.model.agenda("", 0, 0.0), np.int32)
                sizes = np.array([len(ids)])
            rows = np.concatenate([r for r, _ in trace]) if trace else np.zeros(0, np.int64)
            made = np.concatenate([m for _, m in trace]) if trace else np.zeros(0, np.uint64)
            count = np.bincount(rows, minlength=len(some))
            self.merge_start.add(self.merges.used + np.cumsum(count) - count)
            self.merge_count.add(count)
            self.merges.add(made[np.argsort(rows, kind="stable")])
            self.id_start.add(self.ids.used + np.cumsum(sizes) - sizes)
            self.id_count.add(sizes)
            self.ids.add(ids)
            self.numbers.update(zip(some, range(len(self.numbers), len(self.numbers) + len(some)), strict=True))
            self.chars += length * len(some)


class Encoder:
    """Encodes documents; the units met before are kept up to a bound."""

    def __init__(self, model: PieceModel, seed: int, dropout: float) -> None:
        self.model, self.seed, self.dropout = model, mixed(seed & _MASK), dropout
        self.store = Store(model)

    def document_key(self, key: int | None, copy: int = 0) -> int:
        """What the choices in a document depend on; documents without a key share one."""
        return mixed(self.seed ^ mixed((key or 0) & _MASK) ^ mixed(mixed(copy & _MASK)))

    def encode(self, texts: list[tuple[int, str]]) -> list[np.ndarray]:
        """Ids of (document key, text) pairs."""
        ids, sizes = self.encode_all([key for key, _ in texts], [text for _, text in texts])
        return np.split(ids, np.cumsum(sizes)[:-1]) if texts else []

    def encode_all(self, keys: list[int], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of documents one after another."""
        found = [self.model.units(text) for text in texts]
        units = [unit for some in found for unit in some]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        nth = np.arange(len(units)) - np.repeat(np.cumsum(counts) - counts, counts)
        seeds = _mixed_array(np.repeat(np.array(keys, np.uint64), counts) ^ _mixed_array(nth.astype(np.uint64)))
        if self.store.size() > HELD_BYTES:
            self.store = Store(self.model)
        store = self.store
        store.add([unit for unit in dict.fromkeys(units) if unit not in store.numbers and len(unit) <= LONG_UNIT])
        number = np.fromiter((store.numbers.get(unit, -1) for unit in units), np.int64, len(units))
        again = number < 0  # long units
        kept = np.flatnonzero(~again)
        merges = store.merge_count.values[number[kept]]
        made = store.merges.values[ranges(store.merge_start.values[number[kept]], merges)]
        chance = _mixed_array(np.repeat(seeds[kept], merges) ^ made) >> np.uint64(11)
        skipped = chance < np.uint64(int(self.dropout * 2.0 ** 53))
        again[np.repeat(kept, merges)[skipped]] = True
        redo = np.flatnonzero(again)
        new_ids, new_sizes = self.model.segment([units[i] for i in redo.tolist()], seeds[redo], self.dropout)
        # All pieces lie in one pool: those kept, then the new ones; each occurrence takes its range of it.
        starts, sizes = store.id_start.values[number], store.id_count.values[number]
        starts[redo], sizes[redo] = store.ids.used + np.cumsum(new_sizes) - new_sizes, new_sizes
        pool = np.concatenate([store.ids.values[:store.ids.used], new_ids])
        of_text = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)]]
        return pool[ranges(starts, sizes)], np.diff(of_text)


_encoders: dict[tuple, Encoder] = {}


def _encoder(raw: bytes, seed: int, dropout: float) -> Encoder:
    """One encoder per worker process and setting; tasks that follow reuse it."""
    key = (hash(raw), seed, dropout)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(PieceModel(raw), seed, dropout)
    return _encoders[key]


ENCODED = pa.schema([
    ("key", pa.int64()), ("n_tokens", pa.int64()), ("tokens", pa.list_(pa.int32())), ("lossless", pa.bool_()),
])
GROUP_CHARS = 1 << 21  # characters that are encoded together


def encoded(
    docs: DataFrame, key: str = "doc_id", model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED, copies: bool = False,
) -> DataFrame:
    """(key, n_tokens, tokens, lossless) of every row; ``lossless`` says that the decoded tokens are the text.

    Whole texts are encoded. Null and empty texts have no tokens (null is read as empty). Repeated rows give equal tokens;
    with ``copies`` they are cut anew each time, told apart by their place in the table, which must be a stored one.
    Rows without a key share the choices of key 0. Other columns are ignored; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(model).read_bytes())

    def run(parts):
        encoder = _encoder(shared.value, seed, dropout)
        model = encoder.model

        def batch(keys, copy, texts):
            ids, sizes = encoder.encode_all([encoder.document_key(k, c) for k, c in zip(keys, copy, strict=True)], texts)
            ends = np.cumsum(sizes)
            raw = model.decode_all(ids)
            at = np.r_[0, np.cumsum(model.piece_size[ids])][np.r_[0, ends]].tolist()
            # A text that is not empty starts with one more space.
            same = [
                raw[low:high] == (b" " + text.encode("utf-8", "surrogatepass") if text else b"")
                for low, high, text in zip(at[:-1], at[1:], texts, strict=True)
            ]
            tokens = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids, pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sizes), tokens, pa.array(same, pa.bool_())], schema=ENCODED)

        for part in parts:
            held: list[tuple] = []
            chars = 0
            for k, copy, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                text = text.as_py() or ""
                held.append((k, copy, text))
                chars += len(text)
                if chars >= GROUP_CHARS:
                    yield batch(*map(list, zip(*held, strict=True)))
                    held, chars = [], 0
            if held:
                yield batch(*map(list, zip(*held, strict=True)))

    small_batches(docs)
    copy = F.monotonically_increasing_id() if copies else F.lit(0).cast("long")
    rows = docs.select(F.col(key).cast("long"), copy.alias("copy"), F.col("text")).mapInArrow(
        run, "key bigint, n_tokens bigint, tokens array<int>, lossless boolean"
    )
    return rows.withColumnRenamed("key", key)


def decoded(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """The columns of ``tokens`` with a new ``text`` in place of the column ``tokens``; null tokens give a null text."""
    shared = tokens.sparkSession.sparkContext.broadcast(Path(model).read_bytes())
    names = [c for c in tokens.columns if c not in ("tokens", "text")]
    schema = tokens.select(*names).schema.add("text", "string")

    def run(parts):
        reader = _encoder(shared.value, SEED, DROPOUT).model
        for part in parts:
            texts = pa.array([None if t is None else reader.decode(t) for t in part.column("tokens").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], texts], names=[*names, "text"])

    small_batches(tokens)
    return tokens.mapInArrow(run, schema)
