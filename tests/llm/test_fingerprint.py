"""Fingerprints: neighbours and edits exactly, likeness against exact similarity."""

from __future__ import annotations

import hashlib
import random
import re
import statistics

import pytest
import xxhash
from llm_fixtures import docs  # noqa: F401
from pathgauge.llm import fingerprint
from pathgauge.llm.fingerprint import edited_fingerprints


def shingles(text, n=5):
    words = [w for w in text.replace("\x0b", " ").split(" ") if w]
    words = text.split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def jaccard(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def make_rows(count, seed=3):
    source = random.Random(seed)
    return [(source.randrange(10**9), " ".join(f"w{source.randrange(500)}é" for _ in range(source.choice((3, 9, 40, 200, 900))))) for _ in range(count)]


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in ordered]
    for k, (i, _) in enumerate(ordered):
        text, following = texts[k], texts[(k + 1) % len(texts)]
        cut = len(text) // 4
        yield i, text, text[: len(text) - cut] + following[:cut], following


def test_against_exact_similarity(docs):
    rows = make_rows(150) + [(None, "no id at all but five words"), (5, None), (6, ""), (7, " \t "), (8, "one two"), (9, "one two"), (-3, "long " * 20000)]
    rows += [(11, "same id first " * 9), (11, "same id second " * 9), (12, "twice " * 9), (12, "twice " * 9)]
    found = edited_fingerprints(docs(*rows)).collect()
    assert len(found) == len(rows)
    left = [(r.doc_id, r.n_chars, r.edited_sha256) for r in found]
    by_text, errors = {}, []
    got = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in found}
    for i, text, edited, following in expected(rows):
        key = (i, len(text), hashlib.sha256(edited.encode()).hexdigest())
        left.remove(key)
        r = got[key]
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        if edited == text:
            assert r.edited_fingerprint == r.fingerprint and r.near_edited == 1.0
        if following == text:
            assert r.near_next == 1.0
        errors.append(r.near_edited - jaccard(text, edited))
        errors.append(r.near_next - jaccard(text, following))
    assert left == []
    assert max(map(abs, errors)) < 0.2 and statistics.mean(map(abs, errors)) < 0.03 and abs(statistics.mean(errors)) < 0.01


def test_one_row_none_and_plan(docs, capsys):
    only = edited_fingerprints(docs((4, "a b c d e f"))).collect()
    assert [(r.doc_id, r.near_next) for r in only] == [(4, 1.0)]
    assert edited_fingerprints(docs((1, "a")).where("false")).collect() == []
    edited_fingerprints(docs(*make_rows(20))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


def chained(*parts):
    """Spark's hash of several columns: each one's hash is the seed of the next."""
    seed = 42
    for size, part in parts:
        data = part.encode() if size is None else part.to_bytes(size, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed % 2**64)
    return seed - 2**64 if seed >= 2**63 else seed


def plain_fingerprint(text, shingle):
    """Bin by bin: the least hash of each bin, empty bins filled by probes, four bits a bin."""
    words = [chained((None, w)) for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if len(words) >= shingle:
        hashes = [chained(*[(8, h) for h in words[i : i + shingle]]) for i in range(len(words) - shingle + 1)]
    else:
        hashes = [chained(*[(8, h) for h in words])] if words else []
    least = {}
    for h in hashes:
        at = (h >> 56) + 128
        least[at] = min(h, least.get(at, h))
    if not least:
        return ""
    digits = []
    for j in range(256):
        tries = [j, *[table[j] for table in fingerprint._probe_tables()]]
        at = next((t for t in tries if t in least), None)
        if at is None:
            at = min(least, key=lambda b: chained((4, b), (4, j)))
        digits.append("0123456789abcdef"[chained((8, least[at]), (4, j)) & 15])
    return "".join(digits)


@pytest.mark.parametrize("shingle", [1, 5])
def test_equals_a_plain_version(docs, shingle):
    """Also where one shingle fills all bins, and where most bins are filled by themselves."""
    source = random.Random(11)
    texts = ["", " \n", "one", "one two three four", "é 漢字 🙂 a b c", "no\u00a0break \x85next line x y z"]
    texts += [" ".join(f"w{source.randrange(9_000)}" for _ in range(n)) for n in (5, 6, 7, 30, 300, 3_000)] + ["again " * 50]
    df = docs(*enumerate(texts)).select("doc_id", fingerprint.packed_hex(fingerprint.lanes(fingerprint.F.col("text"), shingle)).alias("got"))
    for r in df.collect():
        assert r.got == plain_fingerprint(texts[r.doc_id], shingle), texts[r.doc_id][:40]
