"""Cross-parsing against a plain parse, and held-out accuracy."""

from __future__ import annotations

import math
import random
import zlib

import pyarrow as pa
import pytest

from llm_fixtures import docs  # noqa: F401
from pathgauge.llm import language as g


def greedy_phrases(text, sample):
    """Phrases of ``text``: each time the longest start that occurs in ``sample``, one symbol at least."""
    count = at = 0
    while at < len(text):
        n = 0
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        at += max(n, 1)
        count += 1
    return count


def test_parse_against_plain_search(monkeypatch):
    monkeypatch.setattr(g, "SEGMENT", 40)
    source = random.Random(1)
    samples = {lang: "".join(source.choice(letters) for _ in range(700)).strip() for lang, letters in (("x", "abcd e"), ("y", "bcfg é"))}
    samples = {k: " ".join(v.split()) for k, v in samples.items()}
    model = g._tables(samples)
    texts = ["", "a", "A.B!", "12 ..", "漢字 kanji", "abé " * 60, *["".join(source.choice("abcdefgé zq.,1") for _ in range(source.randrange(150))) for _ in range(60)]]
    bits, sizes, _ = model.parse(pa.array(texts))
    for text, row, size in zip(texts, bits, sizes):
        flat = " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split())
        padded = (flat + " ") if flat else ""  # a text ends like a word
        assert size == len(padded)
        for lang, value in zip(model.names, row):
            phrases = sum(greedy_phrases(padded[k : k + 40], samples[lang]) for k in range(0, len(padded), 40))
            assert value == pytest.approx(phrases * math.log2(len(samples[lang])) / max(1, size))


def words(lang, n, source):
    stems = {"en": "the ing er ation house water", "de": "der ung schaft haus wasser über", "ru": "дом вода ение ость"}[lang].split()
    return " ".join(source.choice(stems) + source.choice(stems) for _ in range(n))


def test_predictions(docs):
    source = random.Random(4)
    rows = [(k, words(lang, source.randrange(3, 60), source), lang) for k in range(400) for lang in [("en", "de", "ru")[k % 3]]]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "123 !!", "de"), (1003, "the water", None), (None, "haus wasser der", None)]
    rows += [(1005, "wasser über haus", "de")] * 2
    found = g.predict_language(docs(*rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, _, lang in rows[:400]:
        r = by_id[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert r.lang_pred == lang and 0 <= r.score <= 1
    assert {by_id[i].lang_pred for i in (1000, 1001, 1002)} == {"und"}
    assert by_id[1003].lang_pred == "en" and by_id[None].lang_pred == "de"


def test_held_out_rows_teach_nothing(docs):
    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 4 == 2]
    rows = [(k, f"words in english number {k}", "held" if k in held else "en") for k in range(60)]
    assert {r.lang_pred for r in g.predict_language(docs(*rows)).collect()} == {"en"}


def test_nothing_to_learn_from_and_empty(docs):
    assert [r.lang_pred for r in g.predict_language(docs((1, "some text", None))).collect()] == ["und"]
    assert g.predict_language(docs((1, "a")).where("false")).collect() == []


def test_filter(docs):
    source = random.Random(5)
    rows = [(k, words(("en", "de")[k % 2], 60, source), ("en", "de")[k % 2]) for k in range(80)]
    noise = "".join(chr(0x4E00 + source.randrange(5000)) for _ in range(400))
    frame = docs(*rows, (900, None), (901, "12 34"), (902, noise, None), (903, "ok", None))
    kept = g.in_learned_language(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {*range(80), 903}


def test_short_foreign_texts_go_and_short_own_ones_stay(docs):
    source = random.Random(6)
    rows = [(k, words(("en", "de")[k % 2], 60, source), ("en", "de")[k % 2]) for k in range(80)]
    foreign = [(1000 + n, "".join(chr(0x4E00 + source.randrange(5000)) for _ in range(n)), None) for n in (10, 40, 150)]
    own = [(2000 + n, words("en", n, source), None) for n in (1, 2, 5, 20)]
    kept = {r.doc_id for r in g.in_learned_language(docs(*rows, *foreign, *own)).collect()}
    assert kept == {*range(80), 2001, 2002, 2005, 2020}


def test_without_a_language_texts_without_a_letter_go_too(docs):
    frame = docs((1, "some text", None), (2, None, None), (3, "12 !", None), (4, "", None))
    assert [r.doc_id for r in g.in_learned_language(frame).collect()] == [1]


def test_one_row_very_often(docs):
    """A third of the rows alike: they come to the driver once, and too many labels are refused."""
    rows = [(k, f"some words of text {k} and more", "en") for k in range(300)]
    hot = docs((7, "always the same short text", "en")).select("*", g.F.explode(g.F.sequence(g.F.lit(1), g.F.lit(20_000)))).drop("col")
    model = g.train(docs(*rows).unionByName(hot))
    assert model.names == ["en"]
    many = docs(*[(k, "a text", f"label {k}") for k in range(30)])
    g.train(many)
    g.MOST_LANGUAGES, before = 20, g.MOST_LANGUAGES
    try:
        g.train(many)
    except ValueError as error:
        assert "more than 20 labels" in str(error)
    else:
        raise AssertionError
    finally:
        g.MOST_LANGUAGES = before
