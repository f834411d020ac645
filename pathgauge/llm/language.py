"""Language by cross-parsing: text is cut into phrases that occur in each language's sample."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathgauge.llm.common import chunks, code_points_before, id_and_text, in_fold, text_bytes

UNDETERMINED = "und"
#: The sample of a language: about so many labelled texts, one piece of so many characters each.
SAMPLE_TEXTS = 40
SAMPLE_PIECE = 800
#: Letters kept of each sample, and of all samples together.
SAMPLE_LETTERS = 16_000
ALL_LETTERS = 128_000
#: Letters told apart; rarer ones share the last 16 symbols.
ALPHABET = 96
#: A text is parsed in segments of this many symbols; a phrase ends where a segment ends.
SEGMENT = 1024
#: Languages told apart at most; a label column with more values is something else.
MOST_LANGUAGES = 4096
#: Phrases that a text may need beyond what its language explains: it begins and ends where
#: it does, and its end is one. They weigh the more the shorter it is.
FREE = 3
_CHUNK = 2 << 20
_CLOSED = 28  # a table entry holds the next state, and above this bit the phrases it closes
_MASK = (1 << _CLOSED) - 1
_ZERO = np.zeros(1, np.int32)


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Suffix automaton as transitions per state; state 0 is the start."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return follow


@dataclass
class LanguageModel:
    names: list[str]
    #: Code point -> symbol; 0 is anything but a letter.
    symbol: np.ndarray
    #: Flat table: entry state + symbol holds the next state and the phrases closed on the way.
    table: np.ndarray
    starts: np.ndarray
    #: Bits that name one phrase of each language's sample.
    phrase_bits: np.ndarray
    #: Bits of one symbol if all were alike; a text that needs more is in no learned language.
    symbol_bits: float

    def parse(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bits per symbol (texts x languages), symbols and letters of each text."""
        data, bounds = text_bytes(texts)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        bounds = code_points_before(data)[bounds]
        symbols = self.symbol[points]
        letter = symbols > 0
        kept = letter.copy()
        kept[1:] |= letter[:-1]  # of a run that isn't letters one symbol stays
        letters = np.concatenate((_ZERO, np.cumsum(letter, dtype=np.int32)))[bounds]
        bounds = np.concatenate((_ZERO, np.cumsum(kept, dtype=np.int32)))[bounds]
        symbols = symbols[kept].astype(np.int32)
        sizes = np.diff(bounds)
        pieces = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = bounds[:-1][owner] + nth * SEGMENT
        length = np.minimum(SEGMENT, sizes[owner] - nth * SEGMENT)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        state = np.repeat(self.starts[:, None], len(owner), axis=1)
        phrases = np.zeros(state.shape, np.int32)
        for step in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length, -step))
            entry = self.table[state[:, :live] + symbols[begin[:live] + step]]
            phrases[:, :live] += entry >> _CLOSED
            state[:, :live] = entry & _MASK
        phrases += state != self.starts[:, None]
        total = np.zeros((len(sizes), len(self.names)))
        np.add.at(total, owner, phrases.T)
        return total * self.phrase_bits / np.maximum(sizes, 1)[:, None], sizes, np.diff(letters)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether the text is in a learned language at all, per text."""
        if not self.names:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        bits, sizes, letters = self.parse(texts)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(bits)), best]
        if len(self.names) > 1:
            second = np.partition(bits, 1, axis=1)[:, 1]
            score = 1 - least / np.maximum(second, 1e-12)
        else:
            score = np.ones(len(bits))
        found = letters > 0
        names = [self.names[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), found.tolist())]
        told = least * sizes - FREE * self.phrase_bits[best] < self.symbol_bits * sizes
        return names, np.where(found, score, 0.0), found & told


def _tables(samples: dict[str, str]) -> LanguageModel:
    letters = Counter(c for text in samples.values() for c in text if c != " ")
    told = {c: 1 + k for k, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET])}
    width = len(told) + 17
    symbol = np.zeros(0x110000, np.int16)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            symbol[point] = told.get(c.lower()[:1]) or len(told) + 1 + point % 16
    names = sorted(samples)
    parts, starts, offset = [], [], 0
    for name in names:
        follow = automaton([symbol[ord(c)].item() for c in samples[name]])
        flat = np.full((len(follow), width), -1, np.int64)
        for state, after in enumerate(follow):
            flat[state, list(after.keys())] = list(after.values())
        fresh = flat[0].copy()  # where a new phrase goes; an unknown symbol is a phrase by itself
        entry = np.where(fresh >= 0, fresh * width + offset, offset + (1 << _CLOSED))
        closed = np.where(np.arange(len(follow)) > 0, 1 << _CLOSED, 0)[:, None]
        parts.append(np.where(flat >= 0, flat * width + offset, entry[None, :] + closed).astype(np.int32).ravel())
        starts.append(offset)
        offset += flat.size
    return LanguageModel(
        names,
        symbol,
        np.concatenate(parts) if parts else np.zeros(0, np.int32),
        np.array(starts, np.int32),
        np.array([math.log2(max(2, len(samples[n]))) for n in names]),
        math.log2(len(told) + 1) if told else 0.0,
    )


def _clean(text: str) -> str:
    """Lower-case letters, one space for every run of anything else."""
    return " ".join("".join(c.lower()[:1] if c.isalpha() else " " for c in text).split())


def train(labelled: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> LanguageModel:
    """Suffix automata over a bounded sample per language.

    The sample is about SAMPLE_TEXTS texts of each non-null label, picked by a
    hash of id and text (repeated rows are one), and SAMPLE_PIECE characters of each from a place that
    the hash gives; at most SAMPLE_LETTERS per language and ALL_LETTERS in all.
    Labels without a letter in their texts are not learned; more than MOST_LANGUAGES
    labels are an error.
    """
    rows = labelled.select(
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("at"),
    ).where("lang is not null and text rlike '\\\\p{L}'")
    different = rows.groupBy("lang").agg(F.approx_count_distinct("at", 0.02).alias("texts"))
    counts = {r["lang"]: max(1, r["texts"]) for r in different.limit(MOST_LANGUAGES + 1).collect()}
    if not counts:
        return _tables({})
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels in {lang_col!r}")
    limits = labelled.sparkSession.createDataFrame(
        [(k, min(2**62, SAMPLE_TEXTS * 2**62 // n)) for k, n in counts.items()], "lang string, upto long"
    )
    room = F.greatest(F.length("text") - SAMPLE_PIECE, F.lit(0)) + 1
    picked = (
        rows.join(F.broadcast(limits), "lang")
        .where(F.shiftrightunsigned("at", 2) <= F.col("upto"))
        .select("lang", "at", F.substring("text", (F.pmod(F.xxhash64("at"), room) + 1).cast("int"), F.lit(SAMPLE_PIECE)).alias("piece"))
        .distinct()  # repeated rows share one hash
        .collect()
    )
    budget = max(1, min(SAMPLE_LETTERS, ALL_LETTERS // len(counts)))
    samples: dict[str, str] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["at"], r["piece"])):
        samples[r["lang"]] = (samples.get(r["lang"], "") + " " + _clean(r["piece"])).strip()[:budget]
    return _tables({k: v for k, v in samples.items() if v})


def predict_language(
    docs: DataFrame,
    folds: int = 4,
    held_out: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``.

    Learned from the rows outside fold ``held_out`` only (crc32 of the id as
    text), predicted from the text alone. The language whose sample needs the
    fewest bits for the text's phrases wins, of equals the first by name.
    ``score`` is the margin to the second best, 0 to 1. ``und`` with score 0: null
    text, no letter, or nothing to learn from. Repeated rows each give a row.
    """
    model = train(docs.where(~in_fold(id_col, folds, held_out)), lang_col, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(**shared.value)
        for batch in chunks(batches, "text", _CHUNK):
            names, score, _ = model.predict(batch.column(2))
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    source = id_and_text(docs, id_col, text_col)
    return source.select("doc_id", in_fold("doc_id", folds, held_out).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def in_learned_language(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is in no learned language; same columns, no shuffle.

    Rejected are texts that are null or without a letter, and texts that even the
    closest sample describes in no fewer bits than letters of equal chance, FREE
    phrases not counted: a margin that is wide for a few words and nothing for a
    page. Where no language can be learned only the former are rejected.
    """
    model = train(docs)
    if not model.names:
        text = F.col("text").cast("string")
        return docs.where(text.isNotNull() & text.rlike("\\p{L}"))
    return docs.where(_accepts(docs.sparkSession.sparkContext.broadcast(vars(model)))(F.col("text").cast("string")))


def _accepts(shared: Broadcast):
    @F.arrow_udf("boolean")
    def accepts(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = LanguageModel(**shared.value)
        for part in texts:
            batch = pa.RecordBatch.from_arrays([part], ["text"])
            found = [model.predict(piece.column(0))[2] for piece in chunks(iter([batch]), "text", _CHUNK)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0, bool), pa.bool_())

    return accepts
