"""Plain versions of the operators, one text after another."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

from marquee.llm import mixing, suffix_tree

SPACE = re.compile(r"[\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def rule_counts(text):
    w, text = words(text), text or ""
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    hit = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def fingerprint(text):
    w = words((text or "").translate(FOLD))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def groups(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def wide_fingerprint(text, parts=8):
    w = words((text or "").translate(FOLD))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 2]) for i in range(len(w) - 1)] or [w[0]]
    value, mask = 0, (1 << 64) - 1
    for part in range(parts):
        hashes = []
        for s in shingles:
            x = xxhash.xxh64_intdigest(s.encode(), 42) + part * 0x9E3779B97F4A7C15 & mask
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
            x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
            hashes.append(x ^ x >> 31)
        value |= sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << 64 * part
    return value


def similar_groups(rows):
    """{doc_id: smallest doc_id of the group} by comparing all pairs of (doc_id, text)."""
    prints = {i: (fingerprint(t), wide_fingerprint(t)) for i, t in rows}
    pairs = [
        (a, b) for a, b in itertools.combinations(prints, 2)
        if near(prints[a][0], prints[b][0]) or (prints[a][1] ^ prints[b][1]).bit_count() <= 56
    ]
    return groups(list(prints), pairs)


def five_word_similarity(a, b):
    x, y = ({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (words(t.translate(FOLD)) for t in (a, b)))
    return len(x & y) / len(x | y)


def near(a, b):
    return ((a ^ b) & (1 << 64) - 1).bit_count() <= 3


def fingerprint_groups(rows):
    """{doc_id: smallest doc_id of the group} of (doc_id, text) with distinct ids."""
    prints = {i: fingerprint(t) for i, t in rows}
    return groups(list(prints), [(a, b) for a, b in itertools.combinations(prints, 2) if near(prints[a], prints[b])])


def line_chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % 2147483647 for x in lines]
    long = [len(words(x)) > 20 for x in lines]
    starts = [
        i for i in range(len(lines))
        if i == 0 or long[i] or long[i - 1] or ((h[i - 1] * 1000003 + h[i]) % 2147483647 >> 7) % 2 == 0
    ]
    return [(s, lines[s:e]) for s, e in zip(starts, [*starts[1:], len(lines)], strict=True)]


def without_repeats(rows):
    """{doc_id: text} of (doc_id, text) with distinct ids."""
    chunks, pairs = set(), set()
    lines = {key: text.split("\n") for key, text in rows if text is not None}
    gone = {key: set() for key in lines}
    for key in sorted(lines):
        own = lines[key]
        for at, part in line_chunks("\n".join(own)):
            most = max(len(words(x)) for x in part)
            if (len(part) > 1 and most) or most > 50:
                if "\n".join(part) in chunks:
                    gone[key].update(range(at, at + len(part)))
                chunks.add("\n".join(part))
        worded = [i for i, x in enumerate(own) if words(x)]
        run, last = [], None
        for a, b in [*zip(worded, worded[1:]), (None, None)]:
            again = a is not None and (own[a], own[b]) in pairs
            if again and last == a:
                run.append(b)
            else:
                if sum(len(words(own[i])) for i in run) > 50:
                    gone[key].update(range(run[0], run[-1] + 1))
                run = [a, b] if again else []
            last = b if again else None
            if a is not None:
                pairs.add((own[a], own[b]))
    out = {key: None for key, _ in rows}
    return out | {key: "\n".join(x for i, x in enumerate(lines[key]) if i not in gone[key]) for key in lines}


def targets(sizes):
    """{source: target}: shares are filled step by step, full sources drop out."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    share = {s: mixing.CYCLE[i % 3] for i, s in enumerate(order)}
    left, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        total = sum(share[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] <= left * share[s] / total}
        if not full:
            target |= {s: left * share[s] / total for s in open_}
            break
        target |= {s: float(3 * sizes[s]) for s in full}
        left -= sum(3 * sizes[s] for s in full)
        open_ -= full
    return target


def mixed(rows):
    """{doc_id: times taken} of (doc_id, source, size, quality) with distinct ids."""
    sizes = Counter()
    for _, source, size, _ in rows:
        sizes[source] += size
    times, goal = {}, targets(sizes)
    for source in sizes:
        epochs = min(3, int(goal[source] // sizes[source])) if sizes[source] else 0
        rest, reached, drawn = goal[source] - epochs * sizes[source], 0, []
        for key, own, size, quality in rows:
            if own == source:
                digest = hashlib.md5(f"{mixing.SEED}|{'null' if key is None else key}".encode()).hexdigest()[:13]
                drawn.append((-math.log((int(digest, 16) + 1.0) / (2.0 ** 52 + 1.0)) / quality, key, size))
        for _, key, size in sorted(drawn):
            extra = epochs < 3 and size > 0 and reached + size / 2 <= rest
            times[key] = epochs + extra if size else 0
            reached += size
    return times


def tree_probability(learned, depth, least_share, least_gain, prior):
    """A function from words to log10 probabilities, by counting every context in a dictionary."""
    counts = defaultdict(Counter)
    for word in learned:
        body = b" " + word + (b" " if word else b"\n") if word else b" \n"
        for i in range(1, len(body)):
            for k in range(min(i, depth) + 1):
                counts[body[i - k:i]][body[i]] += 1
    total = {c: sum(row.values()) for c, row in counts.items()}
    everything = total.get(b"", 0)
    often = {c for c in counts if not c or total[c] >= least_share * everything}
    kept = {b""}
    for c in often - {b""}:
        gain = sum(n * math.log(n / total[c] * total[c[1:]] / counts[c[1:]][a]) for a, n in counts[c].items())
        if gain >= least_gain:
            kept |= {c[i:] for i in range(len(c))}

    def chance(c, a):
        if not c:
            return (counts[b""][a] + 1) / (everything + 256)
        return (counts[c][a] + prior * chance(c[1:], a)) / (total[c] + prior)

    def score(word):
        body = b" " + word + (b" " if word else b"") if word else b" \n"
        result = 0.0
        for i in range(1, len(body)):
            context = next(body[i - k:i] for k in range(min(i, depth), -1, -1) if body[i - k:i] in kept)
            result += math.log10(chance(context, body[i]))
        return result

    return score, chance, kept


def suffix_words(text):
    return suffix_tree.words_of(text)


def cosine_nearest(ids, matrix, every, k):
    norms = np.linalg.norm(matrix, axis=1)
    found = {}
    for i in np.flatnonzero(ids % every == 0):
        score = matrix @ matrix[i] / norms / norms[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        found[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return found


class PieceAgenda:
    """Merge-dropout one merge at a time, with the library's vocabulary and nothing of the operator's."""

    def __init__(self, raw):
        from sentencepiece import SentencePieceProcessor

        self.library = lib = SentencePieceProcessor(model_proto=raw)
        normal = [i for i in range(lib.get_piece_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        self.ids = {lib.id_to_piece(i): i for i in normal}
        self.bytes = {int(lib.id_to_piece(i)[3:-1], 16): i for i in range(lib.get_piece_size()) if lib.is_byte(i)}
        inside = {c for piece in self.ids if len(piece) > 1 for c in piece}
        self.alone = {c for c in "\n\t\r" if c not in inside}

    @staticmethod
    def number(x):
        top = 2**64
        x = (x + 0x9E3779B97F4A7C15) % top
        x = ((x ^ (x // 2**30)) * 0xBF58476D1CE4E5B9) % top
        x = ((x ^ (x // 2**27)) * 0x94D049BB133111EB) % top
        return x ^ (x // 2**31)

    def units(self, text):
        out = []
        for n, part in enumerate(text.split("\u2581")):
            if n:
                out.append(None)  # a literal mark
            held = ""
            for c in ("\u2581" if n == 0 else "") + part.replace(" ", "\u2581"):
                if c in self.alone:
                    out += [held, c] if held else [c]
                    held = ""
                elif c == "\u2581" and held and held[-1] != "\u2581":
                    out.append(held)
                    held = c
                else:
                    held += c
            if held:
                out.append(held)
        return out

    def encode(self, text, key, dropout):
        out = []
        for nth, unit in enumerate(self.units(text) if text else ()):
            if unit is None:
                out += [self.bytes[b] for b in "\u2581".encode()]
                continue
            seed = self.number(key ^ self.number(nth))
            parts, at = list(unit), list(range(len(unit)))
            while True:
                best = None
                for i in range(len(parts) - 1):
                    piece = self.ids.get(parts[i] + parts[i + 1])
                    if piece is None or self.number(seed ^ (at[i] * 2**32 + piece)) // 2**11 < int(dropout * 2.0**53):
                        continue
                    score = self.library.get_score(piece)
                    if best is None or score > best[0]:
                        best = score, i
                if best is None:
                    break
                i = best[1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                del at[i + 1]
            for part in parts:
                out += [self.ids[part]] if part in self.ids else [self.bytes[b] for b in part.encode("utf-8", "surrogatepass")]
        return out
