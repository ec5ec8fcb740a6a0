"""Personal data: base patterns, the field against all segmentations, held-out accuracy, odd inputs."""

import itertools
import math
import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marquee.llm import private_spans as P

ROWS = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])
ROOT = "/root/testdata/sf0.001"


def luhn(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        d = int(d) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    """The patterns as they are written, one after another."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], ("email", "ip", "card", "phone").index(s[0])))


def test_base_patterns():
    rng = random.Random(1)
    alphabets = ("a1.@-", "12.", "0123456789 -", "+1 ().-23456", "ab1.@ +é(5)_%", string.printable)
    for n in range(12_000):
        text = "".join(rng.choice(alphabets[n % len(alphabets)]) for _ in range(rng.randrange(60)))
        assert P.base_spans(text) == plain_base(text), text


def test_base_patterns_on_long_runs():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 100_000, "+1 " * 100_000, "1 2-" * 100_000, "a" * 100_000 + "@b.c"):
        P.base_spans(text)
    assert P.base_spans("x" * 100_000 + "@b.c") == [("email", 0, 100_004)]


def all_segmentations(found):
    """Every set of candidates that do not overlap."""
    for n in range(len(found) + 1):
        for some in itertools.combinations(range(len(found)), n):
            order = sorted(some, key=lambda i: found[i][0])
            if all(found[a][1] <= found[b][0] for a, b in zip(order, order[1:])):
                yield order


@pytest.mark.parametrize("seed", range(12))
def test_field_equals_all_segmentations(seed):
    rng = np.random.default_rng(seed)
    found = []
    for _ in range(9):
        start = int(rng.integers(0, 12))
        found.append((start, start + int(rng.integers(1, 5)), int(rng.integers(0, 4)), [f"f{rng.integers(0, 6)}", "g"]))
    found.sort(key=lambda c: c[0])
    model = P.Model({f"{k}: {n}": float(rng.normal()) for k in P.KINDS for n in ("g", *(f"f{i}" for i in range(6)))}, rng.normal(size=(4, 4)))
    scores = np.array([model.score(k, f) for _, _, k, f in found])

    def total(order):
        touch = sum(model.touching[found[a][2], found[b][2]] for a, b in zip(order, order[1:]) if found[a][1] == found[b][0])
        return scores[order].sum() + touch

    every = list(all_segmentations(found))
    got = model.decode(found)
    best = max(every, key=total)
    assert got == [(P.KINDS[found[i][2]], found[i][0], found[i][1]) for i in best]
    starts, ends, kinds = (np.array([c[i] for c in found]) for i in range(3))
    log_sum, chance, pairs = P.marginals(starts, ends, kinds, scores, model.touching)
    weights = {tuple(o): math.exp(total(o)) for o in every}
    whole = sum(weights.values())
    assert math.isclose(log_sum, math.log(whole), rel_tol=1e-9)
    assert np.allclose(chance, [sum(w for o, w in weights.items() if i in o) / whole for i in range(len(found))])
    touching = sum(w for o, w in weights.items() for a, b in zip(o, o[1:]) if found[a][1] == found[b][0]) / whole
    assert math.isclose(pairs.sum(), touching, abs_tol=1e-9)


def test_candidates_come_by_start_and_cover_the_base():
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choice("a1.@ +(5)-/ [at] dot ") for _ in range(50))
        starts = [c[0] for c in P.candidates(text)]
        assert starts == sorted(starts)
        assert all(0 <= s < e <= len(text) and e - s <= P.MOST_CHARS for s, e, *_ in P.candidates(text))
    for text, spans in P.examples([]):
        assert {(P.KINDS.index(k), s, e) for k, s, e in spans} <= {(k, s, e) for s, e, k, _ in P.candidates(text)}, text


@pytest.fixture(scope="module")
def model(spark):
    return P.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(words))


def card(rng):
    body = "".join(rng.choice(string.digits) for _ in range(15))
    return next(body + d for d in string.digits if luhn(body + d))


def held_out(rng):
    """Pieces of kinds that the patterns miss, with values that training has not seen."""
    for _ in range(60):
        name, host = prose(rng, 1), prose(rng, 1)
        digits = [rng.choice(string.digits[1:]) + "".join(rng.choice(string.digits) for _ in range(n - 1)) for n in (3, 3, 4)]
        number = card(rng)
        fours = [number[i:i + 4] for i in range(0, 16, 4)]
        parts = [str(rng.randrange(256)) for _ in range(4)]
        yield "email", f"{name}.{rng.randrange(9)} at {host} dot org"
        yield "email", f"{name}(at){host}.example.com"
        yield "email", f"{name} [at] {host} [dot] net"
        yield "phone", f"({digits[0]}) {digits[1]}-{digits[2]}"
        yield "phone", ".".join(digits)
        yield "card", ".".join(fours)
        yield "card", "/".join(fours)
        yield "ip", "[.]".join(parts)


def clean(rng):
    """Pieces that hold no personal data."""
    for _ in range(60):
        yield f"{rng.randrange(1990, 2030)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}"
        yield f"version {rng.randrange(9)}.{rng.randrange(9)}"
        yield 'token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"'
        yield f"{rng.randrange(10, 24)}:{rng.randrange(10, 60)}:{rng.randrange(10, 60)}"
        yield f"{rng.randrange(1, 999)},{rng.randrange(100, 999)},{rng.randrange(100, 999)}"
        yield "we met at noon and dot the lines"
        number = card(rng)
        yield number[:-1] + str((int(number[-1]) + 1) % 10)
        yield f"{rng.randrange(100, 999)}{rng.randrange(100, 999)}"


def test_held_out_spans_are_added_and_clean_text_is_left_alone(model):
    rng = random.Random(3)
    caught = total = 0
    for kind, value in held_out(rng):
        before, after = prose(rng, 6), prose(rng, 6)
        text = f"{before} {value} {after}"
        base, added = P.spans_of(text, model)
        caught += (kind, len(before) + 1, len(before) + 1 + len(value)) in base + added
        total += 1
    assert caught >= 0.95 * total
    wrong = [text for text in (f"{prose(rng, 6)} {value} {prose(rng, 6)}." for value in clean(rng)) if any(P.spans_of(text, model))]
    assert len(wrong) <= 0.01 * 480, wrong[:5]


def test_added_spans_do_not_touch_the_table_base(spark, model):
    rows = spark.read.parquet(f"{ROOT}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in P.find(rows, model).collect():
        base = [(s["kind"], s["start"], s["end"]) for s in r.base]
        assert base == plain_base(texts[r.doc_id])
        assert not any(a["start"] < e and s < a["end"] for a in r.added for _, s, e in base)


def test_query(spark):
    import hashlib

    from marquee.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    rows = QUERIES["op13_private_spans"](spark, ROOT).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_base(texts[r.doc_id])
        listed = [":".join(map(str, s)) for s in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in P.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | {""}


def test_odd_rows_and_clashing_columns(spark, model):
    texts = [None, "", "+", "@", "a@b.c", "a@b.c", "😀 a@b.c é +1 234 567 8901", "1" * 5000, "\x00 1.2.3.4 \x00"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x@y.z"), (None, "x@y.z"), (4, "other 1.2.3.4")]
    table = spark.createDataFrame(rows, ROWS)
    for name in ("key", "base", "added", "kind", "start"):
        table = table.withColumn(name, F.lit("other"))
    got = [(r.doc_id, [(s["kind"], s["start"], s["end"]) for s in r.base]) for r in P.find(table, model).collect()]
    assert sorted(got, key=repr) == sorted(((i, plain_base(t or "")) for i, t in rows), key=repr)
    assert P.find(spark.createDataFrame([], ROWS), model).count() == 0


def test_very_long_texts(model):
    for text in ("12 34 " * 60_000, "a1.b2@" * 40_000, "1.2.3.4 " * 20_000, "4539 1488 0343 6467 " * 5_000):
        base, added = P.spans_of(text, model)
        spans = sorted(s[1:] for s in added)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_training_without_any_text(spark):
    empty = P.fit(spark.createDataFrame([(1, None)], ROWS))
    assert P.spans_of("write to ann at mail dot org now", empty)[1] == [("email", 9, 28)]
