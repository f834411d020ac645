"""Collocations against plain counting, and the exact score against whole numbers."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from llm_fixtures import docs  # noqa: F401
from pathgauge.llm import collocations as c


def brute(rows, least=10, subsumed=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(words)
            for size in (1, 2, 3):
                for k in range(len(words) - size + 1):
                    f[lang, words[k : k + size]] += 1
    candidates = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    gone = {(lang, w[k : k + 2]) for (lang, w), v in candidates.items() if len(w) == 3 for k in (0, 1) if 100 * v >= subsumed * f[lang, w[k : k + 2]]}
    found = {}
    for (lang, w), a in candidates.items():
        if (lang, w) not in gone:
            cuts = [(1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, items in found.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(items)[:top], 1)
    )


def texts():
    source = random.Random(5)
    vocabulary = ["Red", "red", "cat", "DOG", "été", "naïve", "a", "b", "x-y", "the", "of", "日本"]
    marks = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", " ; "]
    rows = []
    for _ in range(400):
        lang = source.choice(["en", "en", "fr", None, "und"])
        words = []
        for _ in range(source.randrange(25)):
            words += source.choice([["new", "york", "city"], ["hong", "kong"], [source.choice(vocabulary)], ["the"]])
        rows.append((lang, "".join(w + source.choice(marks) for w in words)))
    return rows + [("en", None), ("en", ""), ("en", " .,;"), (None, None), ("de", "only once")]


@pytest.mark.parametrize("chunk", [300, 4 << 20])
def test_equals_plain_counts(docs, monkeypatch, chunk):
    monkeypatch.setattr(c, "_CHUNK", chunk)
    rows = texts()
    source = docs(*[(k, t, lang) for k, (lang, t) in enumerate(rows)]).selectExpr("*", "1 as prefix", "2 as next", "'z' as pair")
    for least, top in ((10, 2000), (3, 7)):
        found = sorted(tuple(r) for r in c.collocations(source, least=least, top=top).collect())
        assert found == brute(rows, least, top=top)
        assert any(len(r[2].split()) == 3 for r in found) and {r[0] for r in found} >= {"en", "fr", "und"}


def test_every_pair_in_the_filter(docs, monkeypatch):
    """A filter that lets everything through, or is nearly full, changes nothing."""
    monkeypatch.setattr(c, "FILTER_BITS", 64)
    rows = texts()
    found = c.collocations(docs(*[(k, t, lang) for k, (lang, t) in enumerate(rows)]))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_hot_words_and_long_texts(docs):
    rows = [("en", "the the " * 200)] * 30 + [("en", "of the " * 40_000), ("en", "w" * 300_000 + " the"), ("en", "a,b.c" * 5000)]
    found = c.collocations(docs(*[(1, t, lang) for lang, t in rows]))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_empty(docs):
    assert c.collocations(docs((1, "a b")).where("false")).collect() == []
    assert c.collocations(docs((1, None), (2, ""))).collect() == []


def test_score_is_exact(spark):
    source = random.Random(2)
    rows = []
    for _ in range(300):
        left, right = source.randrange(1, 10**13), source.randrange(1, 10**13)
        a = min(left, right) - source.randrange(min(left, right))
        rows.append((a, left, right))
    rows += [(10**13, 10**13, 10**13), (3, 3, 3), (1, 1000, 1000), (1, 1001, 1000), (10**9, 10**9, 10**15)]
    found = spark.createDataFrame(rows, "f long, l long, r long").select("f", "l", "r", c._scored("f", "l", "r").alias("s")).collect()
    assert [r.s for r in found] == [1_000_000 * a * a // (x * y) for a, x, y in rows]


def test_one_shuffle_per_merge(docs):
    plan = c._merged(docs((1, "a b c")).selectExpr("lang", "text").mapInArrow(c._after_words, c._STRIPE))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
