from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from marquee.llm import pieces
from tests.llm import plain

pytestmark = pytest.mark.skipif(not Path(pieces.MODEL).exists(), reason="the vocabulary is not here")
TEXTS = [
    "", "Hello  world", "  a\nb ", "x▁y", "▁▁ a", " ", "é\tñ", "a b  ", "日本語テキスト 混在 text", "\n\n\n", "a▁", " x", "<s> </s> <0x41>",
    "x" * 100 + "hello" * 30, "😀 ok \x00\x01", "The quick brown fox jumps over the lazy dog. " * 20, "tab\t\ttab\r\nline", "ﬁ ﬂ",
]


@pytest.fixture(scope="module")
def raw():
    return Path(pieces.MODEL).read_bytes()


@pytest.fixture(scope="module")
def model(raw):
    return pieces.PieceModel(raw)


def test_without_dropout_equals_the_library(raw, model):
    library = SentencePieceProcessor(model_proto=raw)
    encoder = pieces.Encoder(model, 1, 0.0)
    for text in TEXTS:
        ids = encoder.encode([(0, text)])[0].tolist()
        assert model.decode(ids) == text
        if pieces.MARK not in text:
            assert ids == library.encode(text), text


def test_arrays_equal_the_heap(model):
    units = sorted({u for t in TEXTS for u in model.units(t) if 0 < len(u) <= pieces.LONG_UNIT})
    for key in range(20):
        seeds = np.array([pieces.mixed(1000 * key + i) for i in range(len(units))], np.uint64)
        ids, sizes = model.segment(units, seeds, 0.3)
        cut = [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
        assert cut == [model.agenda(u, int(seed), 0.3) for u, seed in zip(units, seeds, strict=True)]


def test_dropout_varies_and_decodes(model):
    text = TEXTS[15]
    found = set()
    for seed in range(12):
        encoder = pieces.Encoder(model, seed, 0.2)
        for variant in range(4):
            ids = encoder.encode([(encoder.document_key(variant), text)])[0].tolist()
            assert model.decode(ids) == text
            found.add(tuple(ids))
    assert len(found) > 20
    everything = pieces.Encoder(model, 0, 1.0).encode([(0, "abc")])[0]
    assert len(everything) == 4  # no merge at all: the mark and three letters


def test_a_small_store_of_units_changes_nothing(model, monkeypatch):
    whole = pieces.Encoder(model, 1, 0.1)
    want = [whole.encode([(n % 2, t)])[0].tolist() for n, t in enumerate(TEXTS * 3)]
    monkeypatch.setattr(pieces, "HELD_BYTES", 300)
    small = pieces.Encoder(model, 1, 0.1)
    assert [small.encode([(n % 2, t)])[0].tolist() for n, t in enumerate(TEXTS * 3)] == want


def test_share_of_skipped_merges(model):
    units = [u for u in {u for t in TEXTS for u in model.units(t)} if len(u) == 2 and pieces.MARK not in u]
    pair = next(u for u in [*units, "he", "th"] if u in model.ids)
    skipped = sum(len(model.agenda(pair, pieces.mixed(k), 0.25)) == 2 for k in range(4000))
    assert 0.22 < skipped / 4000 < 0.28


def test_slices_do_not_change_the_result(model, monkeypatch):
    encoder = pieces.Encoder(model, 1, 0.1)
    whole = [encoder.encode([(0, t)])[0].tolist() for t in TEXTS]
    monkeypatch.setattr(pieces, "SLICE_CHARS", 5)
    assert [encoder.encode([(0, t)])[0].tolist() for t in TEXTS] == whole


def test_every_occurrence_is_cut_by_itself(raw, model):
    """One word many times in a document: the share of each segmentation is that of independent choices."""
    encoder = pieces.Encoder(model, 5, 0.2)
    unit = "▁internationalization"
    ids = encoder.encode([(encoder.document_key(1), " ".join(["internationalization"] * 4000))])[0].tolist()
    table = model.pieces
    cuts, held = Counter(), []
    for i in ids:
        held.append(table[i])
        if "".join(held) == unit:
            cuts[tuple(held)] += 1
            held = []
    assert not held and sum(cuts.values()) == 4000 and len(cuts) > 50
    alone = Counter(tuple(table[i] for i in model.agenda(unit, pieces.mixed(k), 0.2)) for k in range(4000))
    for cut, n in alone.most_common(5):
        assert abs(cuts[cut] - n) < 5 * (2 * n) ** 0.5


@pytest.mark.parametrize("dropout", [0.1, 0.5])
def test_equals_the_plain_agenda(raw, model, dropout):
    encoder = pieces.Encoder(model, 3, dropout)
    texts = [*TEXTS, "some words come again and some words go\nagain\tand again " * 3]
    keys = [encoder.document_key(n, n % 3) for n in range(len(texts))]
    reference = plain.PieceAgenda(raw)
    for (key, text), ids in zip(zip(keys, texts, strict=True), encoder.encode(list(zip(keys, texts, strict=True))), strict=True):
        assert ids.tolist() == reference.encode(text, key, dropout), text


def test_copies_are_cut_anew(spark, tmp_path):
    text = "several words that can be cut in many ways " * 5
    docs = spark.createDataFrame([(1, text)] * 6, "doc_id long, text string").repartition(2)
    docs.write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    got = pieces.encoded(stored, copies=True).collect()
    assert len({tuple(r.tokens) for r in got}) == 6 and all(r.lossless for r in got)
    assert len({tuple(r.tokens) for r in pieces.encoded(stored).collect()}) == 1


SCHEMA = "doc_id long, text string, tokens string, key string"


def test_operator_and_decoding(spark):
    rows = [(i, t, "c", "k") for i, t in enumerate(TEXTS)] + [(None, None, None, None), (3, TEXTS[3], None, None), (77, "long text " * 300_000, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = pieces.encoded(docs)
    got = out.collect()
    assert len(got) == len(rows) and all(r.lossless and r.n_tokens == len(r.tokens) for r in got)
    assert len({tuple(r.tokens) for r in got if r.doc_id == 3}) == 1
    back = sorted(((r.doc_id, r.text) for r in pieces.decoded(out).collect()), key=repr)
    assert back == sorted(((i, t or "") for i, t, *_ in rows), key=repr)
    assert sorted(map(tuple, out.select("doc_id", "tokens").collect()), key=repr) == sorted(
        map(tuple, pieces.encoded(docs.repartition(5)).select("doc_id", "tokens").collect()), key=repr)


def test_empty_table(spark):
    assert pieces.encoded(spark.createDataFrame([], SCHEMA)).count() == 0
