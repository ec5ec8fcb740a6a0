"""Personal data in texts: exact base patterns, and a semi-Markov conditional random field that adds spans.

A candidate is a segment of the text of at most ``MOST_CHARS`` characters with a kind (email, ip, card, phone). Features
look at the segment as a whole (digits, check digit, groups, separators, what it is glued to, the words before it), and a
segmentation of the text scores the sum of its segments' weights plus a weight for two segments that touch; characters
outside segments score 0. Boundaries and kinds are chosen together by dynamic programming over the candidates in order
of their start: each candidate continues the best segmentation that ends before it, or one that ends where it starts.
Segmentations are linked from their last segment, so the memory of a long text is its found segments and the segments
that are still open.

The field is trained here by maximum likelihood (forward-backward over the same candidates). Its data are pieces of at
most ``SAMPLE_PIECES`` places in about ``SAMPLE_TEXTS`` texts of the table and a few written sentences: what the base
patterns find there is right, other candidates are wrong, and each piece is written in further ways that the patterns do
not know (``name at host dot org``, national numbers, other separators), and in ways that make it wrong (broken check
digit, part above 255).

Plan: one pass over the texts in Arrow batches, no shuffle; the weights of some hundred features go to every task. A text
without digit, ``@`` or written ``at`` and ``dot`` is passed after one scan.
"""

from __future__ import annotations

import bisect
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import batches, sampled
from marquee.session import materialize

KINDS = ("email", "ip", "card", "phone")
MOST_CHARS = 128
MOST_GROUPS = 12
SAMPLE_TEXTS = 4000
SAMPLE_PIECES = 2000
AROUND = 40  # characters kept on either side of a place in a training piece
MOST_PIECE = 400  # longer pieces are not used for training,
MOST_CANDIDATES = 128  # nor are those with more candidates
MOST_SCORE = 30.0  # of a candidate while training, so that sums stay finite
EPOCHS = 120
RATE = 0.5
DECAY = 1e-3

Span = tuple[str, int, int]
Candidate = tuple[int, int, int, list[str]]  # start, end, kind, features

# Words that often stand before personal data.
CUES = {
    "email": ("mail", "email", "write", "contact", "address", "reach"),
    "ip": ("ip", "host", "server", "address", "from", "node"),
    "card": ("card", "visa", "credit", "debit", "number", "iban"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "number", "whatsapp"),
}

# --- base patterns -------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """As the pattern, from the ``@`` on: a run of local characters has one place where it can match, before its ``@``."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield "email", start, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by start, then in the order of ``KINDS``. Leftmost and non-overlapping per kind."""
    spans = list(_emails(text))
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits with separators
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return in_order(spans)


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# --- candidates and their features ----------------------------------------------------------------

#: A text without a match has neither base spans nor candidates.
_PLACE = re.compile(r"[0-9@]|\bdot\b|[\[({] ?at ?[\])}]", re.IGNORECASE)
_AT = re.compile(r" ?@ ?| ?[\[({] ?at ?[\])}] ?| at ", re.IGNORECASE)
_LABEL = re.compile(r"[A-Za-z0-9-]{1,63}")
_DOT = re.compile(r"\.| ?[\[({] ?(?:dot|\.) ?[\])}] ?| dot ", re.IGNORECASE)
_GROUP = re.compile(r"[0-9]+")
_PARTING = re.compile(r" ?[\[(]?\.[\])]? ?| ?[\[(]dot[\])] ?| dot |[ ()/_-]{1,3}|", re.IGNORECASE)
_IP_PARTING = re.compile(r" ?[\[(]?\.[\])]? ?| ?[\[(]dot[\])] ?| dot ", re.IGNORECASE)
_PHONE_PARTING = re.compile(r"[ ()./-]{1,3}")
_CARD_PARTING = re.compile(r"[ ./_-]")
_WORD = re.compile(r"[A-Za-z]+")


def _common(text: str, start: int, end: int, kind: str) -> list[str]:
    out = [""]
    if start and text[start - 1].isalnum():
        out.append("glued left")
    elif start > 1 and text[start - 1] in ".-_@+/%:,\"=" and text[start - 2].isalnum() or start and text[start - 1] in "+@\"=#$%&":
        out.append("tied left")
    if end < len(text) and text[end].isalnum():
        out.append("glued right")
    elif end + 1 < len(text) and text[end] in ".-_@/:,%" and text[end + 1].isalnum():
        out.append("tied right")
    if any(word.lower() in CUES[kind] for word in _WORD.findall(text, max(0, start - 30), start)[-3:]):
        out.append("cue")
    return out


def _email_candidates(text: str) -> Iterator[Candidate]:
    for at in _AT.finditer(text):
        labels = []
        here = _LABEL.match(text, at.end())
        while here and len(labels) < MOST_GROUPS:
            labels.append(here)
            dot = _DOT.match(text, here.end())
            here = dot and _LABEL.match(text, dot.end())
        if len(labels) < 2:
            continue
        low, starts = at.start(), []
        while low and at.start() - low < 64 and text[low - 1] in _LOCAL:
            low -= 1
            if text[low].isalnum() and (low == 0 or not text[low - 1].isalnum()):
                starts.append(low)
        sign = at.group().strip().lower()
        way = "sign" if sign == "@" else "word" if sign == "at" else "bracket"
        for start in starts:
            for n in range(2, len(labels) + 1):
                end = labels[n - 1].end()
                if end - start > MOST_CHARS:
                    break
                last = labels[n - 1].group()
                dots = text[labels[0].end():labels[n - 1].start()].lower()
                if way == "word" and " dot " not in dots:
                    continue  # "at" is a common word: it counts only with written dots
                top = "letters" if last.isalpha() and 2 <= len(last) <= 6 else "other"
                spaced = " " in at.group() and way == "sign"
                out = _common(text, start, end, "email")
                out += [f"at {way}", f"top {top}", f"at {way} top {top}", f"labels {min(n, 4)}"]
                out += ["spaced"] * spaced + (["dots written"] if "dot" in dots or "[" in dots or "(" in dots else [f"{way} dots plain"])
                yield start, end, 0, out


def _ways(text: str, gaps: list[tuple[int, int]]) -> str:
    kinds = {text[a:b] for a, b in gaps}
    return "none" if not kinds else f"only {kinds.pop()}" if len(kinds) == 1 else "mixed"


def _number_candidates(text: str) -> Iterator[Candidate]:
    """Segments that start at a group of digits (or a sign before it) and end with one; groups are read once, ahead."""
    held: list[tuple[int, int]] = []
    source = (m.span() for m in _GROUP.finditer(text))
    ended = False
    while True:
        while not ended and len(held) < MOST_GROUPS + 1:
            following = next(source, None)
            ended = following is None
            if following:
                held.append(following)
        if not held:
            return
        first = held[0][0]
        gaps: list[tuple[int, int]] = []
        digits = ""
        for n, (low, end) in enumerate(held[:MOST_GROUPS], 1):
            if n > 1:
                gap = (held[n - 2][1], low)
                if gap[1] - gap[0] > 7 or not _PARTING.fullmatch(text, *gap):
                    break
                gaps.append(gap)
            if end - low > 19 or len(digits) + end - low > 19:
                break
            digits += text[low:end]
            yield from _numbers_of(text, first, end, digits, gaps, [b - a for a, b in held[:n]])
        del held[0]


def _numbers_of(text: str, first: int, end: int, digits: str, gaps: list, sizes: list[int]) -> Iterator[Candidate]:
    n = len(digits)
    if len(sizes) == 4 and n <= 16 and all(_IP_PARTING.fullmatch(text, *gap) for gap in gaps):
        small = all(map(_small, _GROUP.findall(text, first, end)))
        way = "plain" if all(b - a == 1 for a, b in gaps) else "written"
        yield first, end, 1, [*_common(text, first, end, "ip"), f"small {small}", f"small {small} {way}"]
    if 13 <= n <= 19 and all(_CARD_PARTING.fullmatch(text, *gap) for gap in gaps):
        fours = all(s == 4 for s in sizes[:-1]) and len(sizes) > 1 or sizes == [4, 6, 5]
        right, way = luhn(digits), _ways(text, gaps)
        known = "known" if n > 13 else "short"
        out = [*_common(text, first, end, "card"), f"check {right}", f"check {right} {known}", f"fours {fours}"]
        yield first, end, 2, [*out, f"check {right} parted {way}", "one group" if len(sizes) == 1 else f"fours {fours} check {right}"]
    if 7 <= n <= 15 and len(sizes) <= 7 and all(_PHONE_PARTING.fullmatch(text, *gap) for gap in gaps):
        starts = [first]
        while len(starts) < 3 and starts[-1] and text[starts[-1] - 1] in "+(":
            starts.append(starts[-1] - 1)
        for start in starts:
            plus, whole = text[start] == "+", text[start:end]
            balanced = whole.count("(") == whole.count(")")
            form = f"{'plus' if plus else 'bracket' if '(' in whole else 'bare'} {len(sizes)} groups"
            out = [*_common(text, start, end, "phone"), form, f"balanced {balanced}", f"digits {n}"]
            out += [f"plus {plus} enough {n >= 10}", f"last group {min(sizes[-1], 6)}", "zero first" if digits[0] == "0" else "other first"]
            if not plus:
                out += [f"bare parted {_ways(text, gaps)}", "shape " + "-".join(map(str, sizes[-3:]))]
            yield start, end, 3, out


def candidates(text: str) -> Iterator[Candidate]:
    """All candidates of a text, by start. Groups are read ahead by a bounded number."""
    numbers = _number_candidates(text)
    early: list[tuple[int, int, Candidate]] = []  # signs before a group start it earlier, by at most two characters

    def sorted_numbers() -> Iterator[Candidate]:
        for count, one in enumerate(numbers):
            heapq.heappush(early, (one[0], count, one))
            while early and early[0][0] < one[0] - 2:
                yield heapq.heappop(early)[2]
        while early:
            yield heapq.heappop(early)[2]

    def sorted_emails() -> Iterator[Candidate]:
        found = list(_email_candidates(text))
        yield from sorted(found, key=lambda c: c[:3])

    return heapq.merge(sorted_numbers(), sorted_emails(), key=lambda c: c[0])


# --- the field -------------------------------------------------------------------------------------


@dataclass
class Model:
    """Weights of ``kind: feature`` names, and of kinds that touch."""

    weights: dict[str, float] = field(default_factory=dict)
    touching: np.ndarray = field(default_factory=lambda: np.zeros((len(KINDS), len(KINDS))))

    def score(self, kind: int, features: list[str]) -> float:
        return sum(self.weights.get(f"{KINDS[kind]}: {name}", 0.0) for name in features)

    def decode(self, found: Iterable[Candidate]) -> list[Span]:
        """The best segmentation, its segments in order."""
        touching = self.touching.tolist()
        best: tuple[float, tuple | None] = (0.0, None)  # among segmentations that end before the candidate
        ends: list[int] = []
        open_at: dict[int, list[tuple[float, int, tuple]]] = {}
        for start, end, kind, features in found:
            while ends and ends[0] < start:
                for total, _, node in open_at.pop(heapq.heappop(ends)):
                    if total > best[0]:
                        best = (total, node)
            total, before = best
            for other, last, node in open_at.get(start, ()):
                if other + touching[last][kind] > total:
                    total, before = other + touching[last][kind], node
            total += self.score(kind, features)
            if end not in open_at:
                open_at[end] = []
                heapq.heappush(ends, end)
            # Of the segmentations that end here with one kind only the best can go on.
            same = [i for i, one in enumerate(open_at[end]) if one[1] == kind]
            if not same:
                open_at[end].append((total, kind, ((KINDS[kind], start, end), before)))
            elif total > open_at[end][same[0]][0]:
                open_at[end][same[0]] = (total, kind, ((KINDS[kind], start, end), before))
        for states in open_at.values():
            for total, _, node in states:
                if total > best[0]:
                    best = (total, node)
        spans, node = [], best[1]
        while node:
            spans.append(node[0])
            node = node[1]
        return spans[::-1]


def marginals(starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray, scores: np.ndarray, touching: np.ndarray, times=1.0):
    """(log of the sum over all segmentations, probability of each candidate, expected counts of touching kinds).

    Leading dimensions are pieces; ``times`` weighs them in the counts. Forward sums satisfy a = e (1 + M a) and backward
    sums b = 1 + M' (e b), with e the exponents of the scores and M the weights of what may come before what, so both
    are linear systems. A candidate that only fills a row has score minus infinity.
    """
    own = np.exp(np.minimum(scores, MOST_SCORE))
    before = ends[..., None, :] < starts[..., :, None]
    touch = ends[..., None, :] == starts[..., :, None]
    factor = np.exp(touching[kinds[..., None, :], kinds[..., :, None]])
    moves = before + touch * factor
    unit = np.eye(starts.shape[-1])
    alpha = np.linalg.solve(unit - own[..., :, None] * moves, own[..., None])[..., 0]
    beta = np.linalg.solve(unit - np.swapaxes(moves, -1, -2) * own[..., None, :], np.ones_like(own)[..., None])[..., 0]
    total = 1 + alpha.sum(-1)
    share = touch * factor * alpha[..., None, :] * (own * beta)[..., :, None] / total[..., None, None]
    pairs = np.zeros_like(touching)
    which = np.nonzero(touch)
    every = np.broadcast_to(kinds, starts.shape)
    last, first = every[(*which[:-2], which[-1])], every[which[:-1]]
    np.add.at(pairs, (last, first), share[which] * np.broadcast_to(np.asarray(times)[..., None, None], share.shape)[which])
    return np.log(total), alpha * beta / total[..., None], pairs


@dataclass
class Piece:
    """Candidates of a training text, which of them are right, and how often the same ones occur."""

    found: list[Candidate]
    right: np.ndarray
    times: int


def _pieces(examples: Iterable[tuple[str, list[Span]]]) -> list[Piece]:
    """Training pieces; examples with equal candidates are one. An example whose spans are no candidates is left out."""
    seen: Counter = Counter()
    kept: dict = {}
    for text, spans in examples:
        found = list(candidates(text))
        wanted = {(KINDS.index(kind), start, end) for kind, start, end in spans}
        right = [(k, s, e) in wanted for s, e, k, _ in found]
        if sum(right) != len(wanted) or not found or len(found) > MOST_CANDIDATES:
            continue
        places = sorted({p for s, e, *_ in found for p in (s, e)})
        sign = tuple((bisect.bisect(places, s), bisect.bisect(places, e), k, tuple(f)) for s, e, k, f in found), tuple(right)
        seen[sign] += 1
        kept.setdefault(sign, (found, np.array(right, float)))
    return [Piece(*kept[sign], times) for sign, times in sorted(seen.items())]


def _stacked(pieces: list[Piece], number: dict[str, int]) -> Iterator[tuple]:
    """Pieces with about equally many candidates as arrays, filled up with candidates that cannot be chosen."""
    by_width: dict[int, list[Piece]] = {}
    for piece in pieces:
        by_width.setdefault(1 << (len(piece.found) - 1).bit_length(), []).append(piece)
    for width, alike in by_width.items():
        starts, ends = np.full((len(alike), width), -1), np.full((len(alike), width), -2)
        kinds, right = np.zeros((len(alike), width), int), np.zeros((len(alike), width))
        rows, columns = [], []
        for n, piece in enumerate(alike):
            for i, (start, end, kind, features) in enumerate(piece.found):
                starts[n, i], ends[n, i], kinds[n, i], right[n, i] = start, end, kind, piece.right[i]
                rows += [n * width + i] * len(features)
                columns += [number[f"{KINDS[kind]}: {name}"] for name in features]
        real = starts >= 0
        # A very common piece does not drown the others.
        times = 1 + np.log([piece.times for piece in alike])
        yield np.array(rows), np.array(columns), starts, np.where(real, ends, 1 << 40), kinds, right, real, times


def train(examples: Iterable[tuple[str, list[Span]]], epochs: int = EPOCHS) -> Model:
    """Weights of the largest likelihood with a small penalty, by adaptive steps along the whole gradient."""
    pieces = _pieces(examples)
    names = sorted({f"{KINDS[k]}: {name}" for p in pieces for _, _, k, features in p.found for name in features})
    stacks = list(_stacked(pieces, {name: i for i, name in enumerate(names)}))
    weights, touching = np.zeros(len(names)), np.zeros((len(KINDS), len(KINDS)))
    steps, touching_steps = np.full(len(names), 1e-6), np.full_like(touching, 1e-6)
    observed = np.zeros_like(touching)
    for _, _, starts, ends, kinds, right, _, times in stacks:
        for n, i, j in zip(*np.nonzero((ends[:, :, None] == starts[:, None, :]) & (right[:, :, None] * right[:, None, :] > 0)), strict=True):
            observed[kinds[n, i], kinds[n, j]] += times[n]
    for _ in range(epochs):
        gradient, touching_gradient = -DECAY * weights, observed - DECAY * touching
        for rows, columns, starts, ends, kinds, right, real, times in stacks:
            scores = np.where(real, np.bincount(rows, weights[columns], starts.size).reshape(starts.shape), -np.inf)
            _, chance, pairs = marginals(starts, ends, kinds, scores, touching, times)
            missing = (times[:, None] * (right - chance)).ravel()
            gradient += np.bincount(columns, missing[rows], len(names))
            touching_gradient -= pairs
        steps += gradient**2
        touching_steps += touching_gradient**2
        weights += RATE * gradient / np.sqrt(steps)
        touching += RATE * touching_gradient / np.sqrt(touching_steps)
    return Model(dict(zip(names, weights.tolist(), strict=True)), touching)


# --- training data ---------------------------------------------------------------------------------

#: Written sentences, so that every kind is known whatever the table holds. Their base spans are right, nothing else is.
SENTENCES = (
    "You can write to anna.k_7@post.example.org or call +44 (20) 5550-1234 today.",
    "The server 10.20.30.40 answered, card 4539 1488 0343 6467 was used.",
    "Contact: info@shop.example.net, fax +49 30 555 123 45.",
    "mail bob-12@a.example.de now, number 4539-1488-0343-6467, host 192.168.1.254.",
    "It was 12:30:45 on 2024-05-06, 1,234,567 people and 3.14159 of 99.95.",
    "Version 1.2.3 of 2019 has 1234567 lines in 12 files, see section 4.2.1.7.",
    "Order 20230415 and 1234567890 in room 12-34 at 5.30 pm, pages 100-200.",
    "Ids 550e8400-e29b-41d4-a716-446655440000 and 0123456789abcdef0123456789abcdef stay.",
    "Years 1990 1991 1992 1993 and 2000-2010, sums 100 200 300 400 500.",
    "They met at noon. Dot matrix printers at school dot their desks.",
    "Look at figure 3. At the end 16 08 2021 12 30 was noted, ratio 4/5/6/7.",
    "The index 1234567890123456 and 98765432109876543 are serial numbers.",
)


def _changed(text: str, spans: list[Span], change) -> tuple[str, list[Span]] | None:
    """The example with every span rewritten; ``change`` gives (new text, still right) or None to leave the example out."""
    out, moved, at = [], [], 0
    for kind, start, end in spans:
        new = change(kind, text[start:end])
        if new is None:
            return None
        out.append(text[at:start])
        here = sum(map(len, out))
        out.append(new[0])
        if new[1]:
            moved.append((kind, here, here + len(new[0])))
        at = end
    return "".join(out) + text[at:], moved


def _written(at: str, dot: str, labels: int = MOST_GROUPS):
    """Written signs; of a domain the last ``labels`` parts."""

    def change(kind: str, value: str):
        if kind == "email":
            name, domain = value.split("@")
            return name + at + dot.join(domain.split(".")[-labels:]), True
        return (value.replace(".", dot), True) if kind == "ip" and dot != "." else (value, True)

    return change


def _parted(way: str):
    """National numbers and other separators."""

    def change(kind: str, value: str):
        groups = _GROUP.findall(value)
        if kind == "phone":
            if len(groups) < 3:
                return None
            return {
                "national": f"({groups[1]}) " + "-".join(groups[2:]), "dots": ".".join(groups[1:]), "hyphens": "-".join(groups[1:]),
                "zeros": "00" + " ".join(groups), "zero": "0" + groups[1] + " " + "-".join(groups[2:]), "code": "(+" + groups[0] + ") " + " ".join(groups[1:]),
            }[way], True
        if kind == "card":
            digits = "".join(groups)
            fours = [digits[i:i + 4] for i in range(0, len(digits), 4)]
            return {"dots": ".", "hyphens": "-", "zeros": "/", "zero": " ", "code": "_"}.get(way, "").join(fours), True
        return value, True

    return change


def _broken(kind: str, value: str):
    """Made wrong: another check digit, a part above 255, no top level."""
    if kind == "card":
        return value[:-1] + str((int(value[-1]) + 3) % 10), False
    if kind == "ip":
        return f"{int(value.split('.')[0]) % 9 + 1}99" + value[value.index("."):], False
    if kind == "email":
        return value.split("@")[0] + "@" + value.split("@")[1].split(".")[0], False
    return value.lstrip("+").replace(" ", "").replace("(", "").replace(")", "").replace("-", "").replace(".", ""), False


CHANGES = (
    *(_written(at, dot, labels) for at, dot in ((" at ", " dot "), ("(at)", "."), (" [at] ", " [dot] "), ("[at]", "[.]"), (" (at) ", "(dot)"),
                                                (" @ ", "."), ("@", ".")) for labels in (2, MOST_GROUPS)),
    *map(_parted, ("national", "dots", "hyphens", "zeros", "zero", "code")), _broken,
)


def _apart(spans: list[Span]) -> list[Span]:
    """Spans without those that overlap an earlier one."""
    out: list[Span] = []
    for span in spans:
        if not out or span[1] >= out[-1][2]:
            out.append(span)
    return out


def examples(pieces: Iterable[str]) -> Iterator[tuple[str, list[Span]]]:
    """Each piece with its base spans, and rewritten."""
    for piece in (*SENTENCES, *pieces):
        spans = _apart(base_spans(piece))
        yield piece, spans
        if spans:
            for change in CHANGES:
                changed = _changed(piece, spans, change)
                if changed:
                    yield changed


def places(text: str) -> Iterator[str]:
    """Pieces of a text around its candidates and base spans, cut where nothing stands for a while."""
    spots = sorted([(s, e) for s, e, *_ in candidates(text)] + [(s, e) for _, s, e in base_spans(text)])
    low = high = None
    for start, end in spots:
        if high is not None and start <= high + 2 * AROUND:
            high = max(high, end)
            continue
        if high is not None:
            yield text[max(0, low - AROUND):high + AROUND]
        low, high = start, end
    if high is not None:
        yield text[max(0, low - AROUND):high + AROUND]


def fit(docs: DataFrame, text: str = "text", texts: int = SAMPLE_TEXTS, pieces: int = SAMPLE_PIECES) -> Model:
    """A field trained on at most ``pieces`` places, those with the smallest hash, of about ``texts`` texts: the share of
    them whose hash is small. Texts do not leave their tasks."""
    with_places = docs.select(F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    share = min(1.0, texts / max(1, with_places.count()))
    few = with_places.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < int(share * (1 << 40)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("piece", pa.string())])
        for part in parts:
            found = ((p,) for value in part["text"].to_pylist() for p in places(value) if len(p) <= MOST_PIECE)
            yield from batches(schema, found)

    chosen = materialize(few.mapInArrow(run, "piece string").distinct(), "private-pieces")
    return train(examples(row["piece"] for row in sampled(chosen, "piece", pieces).collect()))


# --- the operator ----------------------------------------------------------------------------------

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def spans_of(text: str | None, model: Model) -> tuple[list[Span], list[Span]]:
    """(base spans, spans that the field adds); an added span overlaps no base span."""
    if not text or not _PLACE.search(text):
        return [], []
    base = base_spans(text)
    taken = _apart(sorted(base, key=lambda s: (s[1], -s[2])))
    ends, added = [s[2] for s in taken], []
    for span in model.decode(candidates(text)):
        nearest = bisect.bisect_right(ends, span[1])
        if nearest == len(taken) or taken[nearest][1] >= span[2]:
            added.append(span)
    return base, added


def find(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, added) of every row: spans (kind, start, end) in code points, end exclusive, in order.

    A null text counts as empty and has no spans. Every row stands for itself, whatever its key; other columns are
    ignored. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("key", pa.string()), ("base", _SPAN), ("added", _SPAN)])

    def rows(part: pa.RecordBatch) -> Iterator[tuple]:
        keys = part["key"].to_pylist()
        for i, name in enumerate(keys):
            base, added = spans_of(part["text"][i].as_py(), shared.value)
            yield name, [dict(zip(("kind", "start", "end"), s, strict=True)) for s in base], [
                dict(zip(("kind", "start", "end"), s, strict=True)) for s in added
            ]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield from batches(schema, rows(part), weigh=lambda row: 64 * (len(row[1]) + len(row[2])))

    made = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key string, base {SPANS}, added {SPANS}"
    )
    return made.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def together(base: Column, added: Column) -> Column:
    """Both lists as one, by start, then in the order of ``KINDS``."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.transform(F.concat(base, added), lambda s: F.struct(
        s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")
    ))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
