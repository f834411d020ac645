"""Periodic runs against a plain search of every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from llm_fixtures import docs  # noqa: F401
from pathgauge.llm import periodicity as p


def brute_runs(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_report(doc_id, text):
    words = re.findall("[^ \t\n\x0b\x0c\r]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % period] for i in range(n)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def lay(texts):
    texts = sorted(texts, key=len, reverse=True)
    flat, marks = [], 10**6
    for t in texts:
        flat += [*t, marks]
        marks += 1
    return np.array(flat, np.int64), np.array([len(t) for t in texts]), texts


def found_runs(texts, least=12):
    flat, sizes, texts = lay(texts)
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    got = [[] for _ in texts]
    for s, e, q in zip(*(x.tolist() for x in p.find_runs(flat, sizes, least))):
        k = int(np.searchsorted(first, s, "right")) - 1
        got[k].append((s - int(first[k]), e - s, q))
    return [(t, sorted(g)) for t, g in zip(texts, got)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("least", [1, 2, 5, 12, 40])
def test_every_stretch_holds_a_block(least):
    for q in range(1, 300):
        block = p.block_of(q, least)
        assert 2 * block - 1 <= max(least, 2 * q) - q < 4 * block - 1
        assert [block] == [b for b in (1 << k for k in range(10)) if any(f <= q <= t for f, t in p._ranges(b, least))]


@pytest.mark.parametrize("least", [1, 2, 12, 30])
def test_runs_equal_brute_force(least):
    source = random.Random(least)
    texts = [[], [1], [1] * 11, [1] * 12, [1] * 300, [1, 2] * 100, fibonacci(400), [source.randrange(2) for _ in range(500)]]
    for _ in range(120):
        alphabet = source.choice([2, 3, 5, 50])
        text = [source.randrange(alphabet) for _ in range(source.randrange(60))]
        for _ in range(source.randrange(4)):
            piece = [source.randrange(alphabet) for _ in range(source.randrange(1, 40))]
            text += piece * source.randrange(1, 6) + piece[: source.randrange(len(piece) + 1)]
            text += [source.randrange(alphabet) for _ in range(source.randrange(20))]
        texts.append(text)
    texts += [list(texts[-1]), list(texts[-1])]  # equal neighbours aren't one text
    for text, got in found_runs(texts, least):
        assert got == sorted(brute_runs(text, least))


def test_small_tiles_change_nothing(monkeypatch):
    monkeypatch.setattr(p, "_TILE", 8)
    monkeypatch.setattr(p, "_STEP", 1)
    for text, got in found_runs([fibonacci(90), [1, 1, 2] * 30, [3] * 50]):
        assert got == sorted(brute_runs(text))


def test_report(docs, monkeypatch):
    source = random.Random(3)
    rows = [(k, None) for k in (0, 1)] + [(2, ""), (3, " \t\n\x0b\x0c\r "), (None, "a b " * 9), (4, "é é " * 15), (4, "é é " * 15)]
    for k in range(5, 220):
        words = [source.choice(["a", "b", "c", "dd", "é", "日本", "A"]) + str(source.randrange(3)) for _ in range(source.randrange(90))]
        words += (words[-source.randrange(1, 9) :] or ["x"]) * source.randrange(1, 6)
        rows.append((k, "".join(w + source.choice([" ", "  ", "\n", "\t"]) for w in words)))
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows) > 5
    for chunk in (200, 1 << 20):
        monkeypatch.setattr(p.chunks, "__defaults__", (chunk,))
        found = [tuple(r) for r in p.run_report(docs(*rows).selectExpr("*", "1 as runs", "2 as collapsed", "3 as best")).collect()]
        assert sorted(found, key=repr) == sorted((brute_report(*r) for r in rows), key=repr)
    assert p.run_report(docs((1, "a")).where("false")).collect() == []


def test_very_long_periodic_texts():
    """A million equal words, and a long period, stay in proportion."""
    flat, sizes, _ = lay([[7] * 1_000_000, list(range(100_000)) * 3])
    start, end, period = p.find_runs(flat, sizes)
    assert list(zip(start.tolist(), end.tolist(), period.tolist())) == [(0, 1_000_000, 1), (1_000_001, 1_300_001, 100_000)]


def test_spans_and_text(docs):
    rows = p.word_runs(docs((1, "x " + "la li  " * 10 + "end"), (2, "no run"))).orderBy("doc_id").collect()
    assert [tuple(r) for r in rows[0].runs] == [(1, 20, 2)] and rows[0].collapsed == "x la li end"
    assert rows[1].runs == [] and rows[1].collapsed == "no run"
