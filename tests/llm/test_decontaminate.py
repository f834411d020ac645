"""Leaks against brute force over all substrings."""

from __future__ import annotations

import random

import pytest

from llm_fixtures import docs  # noqa: F401
from pathgauge.llm import decontaminate as d


def edit_distance_to_part(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        before, row[0] = row[0], i
        for j, x in enumerate(text, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (c != x))
    best = min(row)
    return best, row.index(best)


def garble(text, edits, source):
    chars = list(text)
    for _ in range(edits):
        at = source.randrange(len(chars))
        what = source.randrange(3)
        if what == 0:
            chars[at] = "z"
        elif what == 1:
            chars.insert(at, "q")
        elif len(chars) > 1:
            del chars[at]
    return "".join(chars)


def test_bit_parallel_distance():
    source = random.Random(1)
    for _ in range(300):
        pattern = "".join(source.choice("abc ") for _ in range(source.randrange(1, 90)))
        text = "".join(source.choice("abc ") for _ in range(source.randrange(120)))
        if source.random() < 0.7:
            text = text[:40] + garble(pattern, source.randrange(6), source) + text[40:]
        expected = edit_distance_to_part(pattern, text)
        distance, end = d.search(pattern, text)
        assert distance == expected[0]
        assert distance == len(pattern) or end == expected[1]


def sentence(source, words):
    return " ".join("".join(source.choice("aeinorst") for _ in range(source.randrange(2, 9))) for _ in range(words))


@pytest.fixture(scope="module")
def case():
    source = random.Random(5)
    items = {k: sentence(source, 8 + 3 * k) for k in range(10)}
    items[10], items[11], items[12] = None, "", "too short"
    rows = []
    for k in range(120):
        text = sentence(source, 60)
        if k % 2:
            item = items[source.randrange(10)]
            text = text + "\n" + garble(item, source.randrange(0, 2 + len(item) // 10), source).upper() + "\n\t" + sentence(source, 9)
        rows.append((k, text))
    rows += [(500, None), (501, ""), (502, items[3] * 3), (None, items[4]), (7, items[5]), (7, items[5])]
    return items, rows


def expected_hits(items, rows):
    found = []
    for i, text in rows:
        for k, item in items.items():
            pattern, plain = d.plain(item), d.plain(text)
            if len(pattern) < d.LEAST_CHARS or not plain:
                continue
            distance, _ = edit_distance_to_part(pattern, plain)
            if distance <= len(pattern) // d.CHARS_PER_ERROR:
                found.append((i, k, distance))
    return sorted(found, key=repr)


def test_against_brute_force(spark, docs, case, monkeypatch):
    items, rows = case
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    expected = expected_hits(items, rows)
    assert len({k for _, k, _ in expected}) == 10
    frame = docs(*rows)
    hits = lambda: sorted(((r.doc_id, r.item_id, r.distance) for r in d.benchmark_hits(frame, benchmark).collect()), key=repr)
    assert hits() == expected
    kept = d.without_benchmark(frame, benchmark)
    assert kept.columns == frame.columns
    dirty = {(i, t) for i, t in rows for j, _, _ in expected_hits(items, [(i, t)])}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(((i, t) for i, t in rows if (i, t) not in dirty), key=repr)
    monkeypatch.setattr(d, "BLOCK_BYTES", 200)  # several passes, the same hits
    assert hits() == expected


def test_empty_tables(spark, docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    frame = docs((1, "some text"))
    assert d.benchmark_hits(frame, nothing).collect() == []
    assert d.without_benchmark(frame, nothing).count() == 1
    benchmark = spark.createDataFrame([(1, "a benchmark item that is long enough")], "item_id long, text string")
    assert d.benchmark_hits(frame.where("false"), benchmark).collect() == []


def test_short_items_between_word_borders(spark, docs):
    benchmark = spark.createDataFrame([(1, "19 x 23 = ?"), (2, "世界上最高的山是什么？"), (3, "cat sat"), (4, "who wrote hamlet"), (5, " ")], "item_id long, text string")
    frame = docs((1, "so 19 X 23  = ? is"), (2, "问题：世界上最高的山是什么？珠峰"), (3, "a bobcat sat"), (4, "the cat sat."), (5, "x who wrote hamlt y"), (6, "119 x 23 = ?"), (7, ""))
    hits = {(r.doc_id, r.item_id, r.distance) for r in d.benchmark_hits(frame, benchmark).collect()}
    assert hits == {(1, 1, 0), (2, 2, 0), (4, 3, 0), (5, 4, 1)}
    assert {r.doc_id for r in d.without_benchmark(frame, benchmark).collect()} == {3, 6, 7}
