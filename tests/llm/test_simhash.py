"""SimHash against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from llm_fixtures import docs  # noqa: F401
from pathgauge.llm import simhash
from pathgauge.llm.components import components


def brute_fingerprint(text, shingle=3):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_copies(count, seed=1):
    source = random.Random(seed)
    base = [f"w{source.randrange(40)}" for _ in range(300)]
    texts = []
    for _ in range(count):
        words = list(base)
        for _ in range(source.randrange(4)):
            words[source.randrange(len(words))] = f"x{source.randrange(1000)}"
        texts.append(" ".join(words))
    return texts


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "one two",
    "ONE two",
    "É é É",
    "a b c",
    "A  b\tC",
    "a b c a b c a b c",
    "tie " * 50,
    *near_copies(60),
    "long " * 30000 + "end",
]


@pytest.mark.parametrize("distance", [2])
def test_against_brute_force(docs, distance):
    rows = [(10 * k + 3, t) for k, t in enumerate(TEXTS)]
    prints = {i: brute_fingerprint(t) for i, t in rows}
    found = simhash.simhash_components(docs(*rows), distance=distance).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in found} == prints
    assert {r.doc_id: r.component_id for r in found} == brute_components(prints, distance)


def test_crowded_bucket_is_split_without_loss(spark, monkeypatch):
    """Fingerprints that crowd one bucket, all within a few bits of one another."""
    source = random.Random(3)
    centre = source.getrandbits(64)
    prints = {centre}
    while len(prints) < 300:
        other = source.choice(sorted(prints))
        for _ in range(source.choice((1, 2, 2, 5))):
            other ^= 1 << source.randrange(64)
        prints.add(other)
    frame = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    monkeypatch.setattr(simhash, "BUCKET", 4)
    edges = simhash.links(frame)
    roots = {r.node: r.root for r in components(edges, "a", "b").collect()}
    signed = {int(np.uint64(p).astype(np.int64)): p for p in prints}
    expected = brute_components({s: p for s, p in signed.items()}, 2)
    assert {s: roots.get(s, s) for s in signed} == expected


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (5, 4)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(frame, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{k: 100 for k in range(101, 160)}}


def test_nulls_repeats_and_empty(docs, spark):
    frame = docs((None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (2, "q w e r"))
    found = sorted(((r.doc_id, r.component_id) for r in simhash.simhash_components(frame).collect()), key=repr)
    assert found == [(2, 2), (5, 5), (5, 5), (None, 5)]
    assert simhash.simhash_components(docs((1, "a")).where("false")).collect() == []
    kept = simhash.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "q w e r"), (5, "a b c d")]


def test_every_component_keeps_one_row(docs):
    """Several null ids, and one id over two unlike texts."""
    a, b, c, e = ("alpha beta gamma delta", "one two three four", "red green blue", "north south east")
    for x, y in ((a, b), (b, a)):
        frame = docs((5, x), (5, y), (3, y), (None, c), (None, c), (None, e), (None, x))
        kept = simhash.keep_first(frame)
        assert kept.columns == frame.columns
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(5, x), (3, y), (None, c), (None, e)], key=repr)


def test_other_distances_are_refused(docs):
    with pytest.raises(ValueError):
        simhash.simhash_components(docs((1, "a b c")), distance=3).collect()
