"""Collocations by the stripes pattern: every prefix keys a counter of the words that follow it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathgauge.llm.common import byte_class, chunks, hash_spans, mix, runs, text_bytes
from pathgauge.sources.stages import store

#: A phrase is a candidate from so many occurrences on.
LEAST = 10
#: A candidate goes if a longer one that holds it has this percentage of its occurrences.
SUBSUMED = 50
#: Phrases reported per language.
TOP = 2000
#: A stripe is dealt out to this many parts by its next words, so that no common prefix meets in one task.
PARTS = 16
#: Bits of the filter that says which pairs may be candidates; its size is fixed.
FILTER_BITS = 1 << 25
#: Texts are counted in pieces of about this many bytes; one longer text is a piece of its own.
_CHUNK = 4 << 20

_CUT = byte_class(b".,;:!?\n\v\f\r")
_WORD = ~(_CUT | byte_class(b" \t"))
_UPPER = byte_class(bytes(range(65, 91)))
#: A stripe travels as one text of elements ``next count``, a tab between them: words hold neither space nor tab.
_STRIPE = "lang string, prefix string, part int, stripe string"


class _Words:
    """The words of some texts: number, piece and language of each, and the distinct words."""

    def __init__(self, texts: pa.Array, langs: pa.Array) -> None:
        data, bounds = text_bytes(texts)
        data = data + _UPPER[data] * np.uint8(32)
        starts, ends = runs(data, _WORD)
        self.piece = np.cumsum(_CUT[data], dtype=np.int64)[starts] if len(starts) else starts
        coded = langs.dictionary_encode()
        row = np.searchsorted(bounds, starts, "right") - 1
        self.lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]
        self.langs = coded.dictionary
        offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
        packed = data[_WORD[data]]
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(packed)).dictionary_encode()
        self.word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = words.dictionary
        first = np.zeros(len(self.words), np.int64)
        first[self.word[::-1]] = np.arange(len(starts))[::-1]
        self.hashes = hash_spans(data, starts[first], ends[first])

    def lang_hashes(self) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(x or "") for x in self.langs.to_pylist()], np.uint64)


def _pair_hash(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(lang + first * np.uint64(0x9E3779B97F4A7C15) + mix(second))


def _batch(lang: pa.Array, prefix: pa.Array, group: np.ndarray, part: np.ndarray, following: pa.Array, count: np.ndarray):
    """Stripes out of counts: ``group`` says which elements share a prefix; ``lang`` and ``prefix`` go by element."""
    key = group * PARTS + part
    order = np.argsort(key, kind="stable")
    begin = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
    head = pa.array(order[begin])
    kind = pa.string()
    numbers = pa.array(count[order]).cast(kind)
    elements = pc.binary_join_element_wise(following.take(pa.array(order)).cast(kind), numbers, pa.scalar(" ", kind))
    stripes = pa.ListArray.from_arrays(pa.array(np.append(begin, len(key)).astype(np.int32)), elements)
    columns = [
        lang.take(head).cast(pa.string()),
        prefix.take(head).cast(pa.string()),
        pa.array(part[order[begin]].astype(np.int32)),
        pc.binary_join(stripes, "\t"),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "part", "stripe"])


def _after_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of single words, with the prefix's own count as the element of an empty next word.

    The stripe of the empty prefix has that element alone: the words of a language.
    """
    for batch in chunks(batches, "text", _CHUNK):
        w = _Words(batch.column(1), batch.column(0))
        size, ends = len(w.words) + 1, len(w.words)  # the last number is the empty word
        if not ends:
            continue
        together = np.flatnonzero(w.piece[1:] == w.piece[:-1])
        prefix = w.lang * size + w.word
        pair, pairs = np.unique(prefix[together] * size + w.word[together + 1], return_counts=True)
        own, owns = np.unique(prefix, return_counts=True)
        lang, langs = np.unique(w.lang, return_counts=True)
        key = np.concatenate((pair, own * size + ends, (lang * size + ends) * size + ends))
        group, following = key // size, key % size
        part = np.append(w.hashes % np.uint64(PARTS), np.uint64(0)).astype(np.int64)[following]
        words = pa.concat_arrays([w.words, pa.array([""], w.words.type)])
        count = np.concatenate((pairs, owns, langs))
        yield _batch(w.langs.take(pa.array(group // size)), words.take(pa.array(group % size)), group, part, words.take(pa.array(following)), count)


def _after_pairs(shared: Broadcast):
    """Stripes of word pairs, where both pairs of the three words may be candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in chunks(batches, "text", _CHUNK):
            w = _Words(batch.column(1), batch.column(0))
            size = len(w.words)
            if len(w.word) < 3:
                continue
            place = _pair_hash(w.lang_hashes()[w.lang[:-1]], w.hashes[w.word[:-1]], w.hashes[w.word[1:]]) % np.uint64(FILTER_BITS)
            pair = (frequent[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
            pair &= w.piece[1:] == w.piece[:-1]
            at = np.flatnonzero(pair[:-1] & pair[1:])
            if not len(at):
                continue
            pairs, group = np.unique((w.lang[at] * size + w.word[at]) * size + w.word[at + 1], return_inverse=True)
            key, count = np.unique(group * size + w.word[at + 2], return_counts=True)
            group, following = key // size, key % size
            first, second = pairs[group] // size, pairs[group] % size
            space = pa.scalar(" ", w.words.type)
            prefix = pc.binary_join_element_wise(w.words.take(pa.array(first % size)), w.words.take(pa.array(second)), space)
            part = (w.hashes % np.uint64(PARTS)).astype(np.int64)[following]
            yield _batch(w.langs.take(pa.array(first // size)), prefix, group, part, w.words.take(pa.array(following)), count)

    return run


def _merged(stripes: DataFrame) -> DataFrame:
    """(lang, prefix, part, next, count): all stripes of a prefix added element by element, in one shuffle."""
    return (
        stripes.repartition("lang", "prefix", "part")
        .select("lang", "prefix", "part", F.explode(F.split("stripe", "\t")).alias("element"))
        .groupBy("lang", "prefix", "part", F.substring_index("element", " ", 1).alias("next"))
        .agg(F.sum(F.substring_index("element", " ", -1).cast("long")).alias("count"))
    )


def _pair_filter(pairs: DataFrame) -> np.ndarray:
    """Bits of all candidate pairs (lang, prefix, next); FILTER_BITS of them however many pairs there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = []
            for column in (1, 2):
                data, bounds = text_bytes(batch.column(column))
                hashes.append(hash_spans(data, bounds[:-1], bounds[1:] - 1))
            coded = batch.column(0).dictionary_encode()
            names = np.array([xxhash.xxh64_intdigest(x or "") for x in coded.dictionary.to_pylist()], np.uint64)
            place = _pair_hash(names[coded.indices.to_numpy(zero_copy_only=False)], *hashes) % np.uint64(FILTER_BITS)
            at, bit = (place >> np.uint64(6)).astype(np.int32), np.uint64(1) << (place & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bit.view(np.int64))], ["at", "bit"])

    bits = pairs.select("lang", "prefix", "next").mapInArrow(run, "at int, bit long")
    found = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint64)


def _scored(a: str, left: str, right: str):
    """Score of one cut, exact: products of 18-digit numbers stay within 38 digits for any count that fits a corpus."""
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    product = F.lit(1_000_000).cast("decimal(7,0)") * wide(a) * wide(a)
    return F.call_function("div", product, wide(left) * wide(right))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    subsumed: int = SUBSUMED,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two and three words per language.

    Words are runs of anything but space and tab in the pieces of a text between
    ``.,;:!?`` and line ends, A-Z lower-cased; phrases don't leave a piece. Phrases
    of at least ``least`` occurrences are candidates, scored by 1,000,000 times
    a*a/(l*r), rounded down, at their worst cut (the earliest of equals). One that
    lies in a longer candidate of ``subsumed`` per cent of its occurrences goes.

    A stripe is a prefix with a counter of its next words, made per piece of text
    and merged element by element. The stripes of single words give the pairs and,
    as an element of each, the prefix's own count; those of pairs give the threes,
    and the largest element of a pair's stripe and of those that end in the pair
    is what may subsume it. Pairs that aren't candidates open no stripe (a filter of
    fixed size lets a few through, which their count then leaves out). Stripes
    are dealt out by prefix and next word, so a common prefix doesn't meet in one task.

    Null texts are empty, a null language is ``und``; repeated rows count each time.
    An empty table, or one without a candidate, gives no rows. A single text needs
    about 25 times its size while it is counted.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    source = docs.select(lang.alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    stripes = _merged(source.mapInArrow(_after_words, _STRIPE)).where(F.col("count") >= least)
    stripes = store(stripes.select("lang", "prefix", "next", F.col("count").alias("f")), "stripes")
    sizes = stripes.where("prefix = '' and next = ''").select("lang", F.col("f").alias("n"))
    words = stripes.where("prefix <> '' and next = ''").select("lang", F.col("prefix").alias("word"), "f")
    pairs = stripes.where("next <> ''").withColumn("pair", F.concat_ws(" ", "prefix", "next"))

    shared = spark.sparkContext.broadcast(_pair_filter(pairs))
    threes = store(
        _merged(source.mapInArrow(_after_pairs(shared), _STRIPE)).where(F.col("count") >= least).select("lang", "prefix", "next", F.col("count").alias("f")),
        "threes",
    )
    tail = F.concat_ws(" ", F.substring_index("prefix", " ", -1), "next")
    longer = (
        threes.select("lang", F.col("prefix").alias("pair"), "f")
        .unionAll(threes.select("lang", tail.alias("pair"), "f"))
        .groupBy("lang", "pair")
        .agg(F.max("f").alias("longest"))
    )

    def with_count(frame: DataFrame, counted: DataFrame, key: str, on: str, name: str) -> DataFrame:
        return frame.join(counted.select("lang", F.col(key).alias(on), F.col("f").alias(name)), ["lang", on])

    two = pairs.join(longer, ["lang", "pair"], "left").where(F.coalesce(F.col("longest") * 100 < F.col("f") * subsumed, F.lit(True)))
    two = with_count(two, words, "word", "prefix", "l")
    two = with_count(two, words, "word", "next", "r")
    two = two.select("lang", F.col("pair").alias("phrase"), F.col("f").alias("a"), "l", "r", _scored("f", "l", "r").alias("score"))

    three = threes.select("lang", "prefix", "next", "f", F.substring_index("prefix", " ", 1).alias("first"), tail.alias("tail"))
    three = with_count(three, words, "word", "first", "l1")
    three = with_count(three, pairs, "pair", "tail", "r1")
    three = with_count(three, pairs, "pair", "prefix", "l2")
    three = with_count(three, words, "word", "next", "r2")
    cut = lambda k: F.struct(_scored("f", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
    three = three.withColumn("cut", F.least(cut(1), cut(2))).select(
        "lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"
    )

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
