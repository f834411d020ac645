"""Piece ids against the SentencePiece library, and exact round trips."""

from __future__ import annotations

import dataclasses
import random
import tracemalloc

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from llm_fixtures import docs  # noqa: F401
from pathgauge.llm import pieces

ALPHABET = " aeintrshlouc.,\n\téüß漢字🙂\x00ABC019-_'\"()"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.load(pieces.default_model()))


def ids(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], np.int32).tolist()


def texts(count=400, seed=2):
    source = random.Random(seed)
    words = sorted(pieces.load(pieces.default_model()).ids)
    found = ["", " ", "  a  b \n", "▁x", "a\x00b", "\n\n \n", "word" * 400, " " * 700 + "end", "end" + " " * 33]
    for _ in range(count):
        text = "".join(source.choice(ALPHABET) for _ in range(source.randrange(30)))
        found.append(text.replace("a", "   ") if source.random() < 0.2 else text)
        found.append("".join(source.choice(words) for _ in range(4)))
    return found


def test_bpe_vocabulary_equals_library(encoder, library):
    for text in texts():
        assert ids(encoder, text) == library.encode(text), text


def test_shared_prefixes_change_nothing(encoder):
    words = ["▁the", "▁then", "▁thence", "▁there", "▁there", "▁t", "them", "▁▁the", "\n"]
    fresh = [pieces.Encoder(encoder.vocabulary) for _ in words]
    for e, w in zip(fresh, words):
        e.learn({w})
    together = pieces.Encoder(encoder.vocabulary)
    together.learn(set(words))
    assert [together.known[w] for w in words] == [e.known[w] for e, w in zip(fresh, words)]


def test_memory_turns_over(encoder, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    small = pieces.Encoder(encoder.vocabulary)
    for text in ["a b c d", "b c e f g", "a b", "h i j k", "b"] * 2:
        assert ids(small, text) == ids(encoder, text)
    assert len(small.known) + len(small.older) < 14


def test_pairs_are_bounded(encoder, library, monkeypatch):
    """Also within one word: what is remembered of neighbouring pieces turns over without a change of the result."""
    monkeypatch.setattr(pieces, "PAIRS", 500)
    small, source = pieces.Encoder(encoder.vocabulary), random.Random(7)
    for length in (20, 3_000, 50):
        text = " ".join("".join(source.choice("aeintrshlou0123ABC") for _ in range(length)) for _ in range(20))
        assert ids(small, text) == library.encode(text)
        assert len(small.pairs) <= 500 and len(small.older_pairs) <= 500
    assert len(small.older_pairs) == 500


def test_unigram_vocabulary_equals_library(tmp_path):
    """The same pieces as a UNIGRAM model: the best total score wins."""
    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.default_model(), "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    source = random.Random(4)
    for piece in model.pieces:
        if piece.type == 1:
            piece.score = -4.0 - source.randrange(1, 4000) / 256
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    encoder = pieces.Encoder(pieces.load(str(path)))
    scores = encoder.vocabulary.scores
    total = lambda ids: sum(scores[library.id_to_piece(i)] for i in ids)
    for text in ["the theater there then", "reading and writing of words", "unbelievable internationalisation"]:
        assert total(ids(encoder, text)) == pytest.approx(total(library.encode(text)))


def test_operators(docs, library):
    rows = [(k, t) for k, t in enumerate(texts(40))] + [(900, None), (None, "no id"), (1, "twice"), (1, "twice")]
    frame = docs(*rows)
    encoded = pieces.encode(frame)
    assert set(frame.columns) <= set(encoded.columns) and encoded.columns[-2:] == ["ids", "n_tokens"]
    back = pieces.decode(encoded).collect()
    assert len(back) == len(rows)
    for r in back:
        assert list(r.ids) == library.encode(r.text or "") and r.n_tokens == len(r.ids)
        assert r.decoded == (r.text or "").replace("▁", " ")
    report = pieces.token_report(frame.where("text not like '%▁%' or text is null"))
    assert all(r.round_trip for r in report.collect())
    assert pieces.token_report(frame.where("false")).collect() == []


def test_other_normalisers_are_refused(tmp_path):
    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.default_model(), "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.load(str(path))


def test_long_run_without_spaces(encoder, library):
    """Memory grows with the run, not with its square; BPE equals the library, UNIGRAM the best score."""
    source = random.Random(6)
    run = "".join(source.choice("abcdefghijklmnopqrstuvwxyz0123456789+/=漢字文中") for _ in range(200_000))
    best = dataclasses.replace(encoder.vocabulary, is_bpe=False)
    for fresh in (pieces.Encoder(encoder.vocabulary), pieces.Encoder(best)):
        tracemalloc.start()
        found = ids(fresh, run)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 300 << 20
        assert b"".join(best.spelled[i] for i in found).decode() == " " + run
        assert not any(len(w) > pieces.LONGEST for w in fresh.known)
        if fresh.vocabulary.is_bpe:
            assert found == library.encode(run)
