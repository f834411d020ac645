"""Nearest neighbours against a full comparison, the graph's parts, and odd vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from pathgauge.llm import neighbours as nb

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20):
    """Nearest by plain sums over the components in order; ids are unique."""
    x = {i: [float(np.float32(c)) for c in v] for i, v in rows}
    found = []
    for q in x:
        if q % 20 == 0:
            scores = []
            for i, v in x.items():
                if i != q:
                    total = 0.0
                    for a, b in zip(x[q], v):
                        total += a * b
                    scores.append((-total, i))
            found += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(found)


def clusters(n, dim, groups, seed=1, spread=0.4):
    source = np.random.default_rng(seed)
    centres = source.standard_normal((groups, dim))
    x = centres[source.integers(groups, size=n)] + spread * source.standard_normal((n, dim))
    return (x / np.linalg.norm(x, axis=1, keepdims=True) * source.uniform(0.5, 2, (n, 1))).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1) for i, v in rows], SCHEMA).selectExpr(
        "*", "1 as cell", "'p' as parts", "2 as score", "3 as rank"
    )


def recall(found, expected):
    truth = {(q, i) for q, _, i, _ in expected}
    return len({(r.query_id, r.vec_id) for r in found} & truth) / len(truth)


def test_parts_are_balanced_and_follow_the_graph():
    x = clusters(2048, 8, 16, spread=0.1)
    likeness = x @ x.T
    np.fill_diagonal(likeness, -np.inf)
    near = np.argsort(-likeness, axis=1)[:, :10]
    part = nb.bisected(near, 16)
    assert np.bincount(part, minlength=16).tolist() == [128] * 16
    assert (part[near] == part[:, None]).mean() > 0.5  # by chance 0.06
    assert sorted(np.bincount(nb.bisected(near[:1000] % 1000, 8))) == [125] * 8


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(nb, "CELL_ROWS", (100, 300))
    rows = list(enumerate(clusters(4000, 16, 40)))
    expected = brute(rows)
    found = nb.nearest(frame(spark, rows)).collect()
    assert len(found) == len(expected) == 200 * 20
    assert recall(found, expected) >= 0.9
    exact = {(q, i): s for q, _, i, s in expected}
    by_query = {}
    for r in found:
        assert math.isclose(r.score, exact.get((r.query_id, r.vec_id), r.score), rel_tol=0, abs_tol=0)
        by_query.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    for listed in by_query.values():
        listed.sort()
        assert [x[0] for x in listed] == list(range(1, 21))
        assert [x[1:] for x in listed] == sorted(x[1:] for x in listed)


def test_probes_fewer_parts_than_there_are(spark):
    x = clusters(4000, 16, 40).astype(np.float64)
    likeness = x @ x.T
    np.fill_diagonal(likeness, -np.inf)
    weights, mass = nb.train(x, np.argsort(-likeness, axis=1)[:, :20], 64, 0.95)
    odds = -np.sort(-nb._probabilities(x, weights), axis=1)
    probed = (odds.cumsum(axis=1) - odds < mass).sum(axis=1)
    assert probed.mean() < 24


def test_every_part_probed_is_exact(spark, monkeypatch):
    """With all parts probed, odd data included, the result equals the full comparison."""
    monkeypatch.setattr(nb, "CELL_ROWS", (40, 90))
    monkeypatch.setattr(nb, "_TILE", 500)
    source = np.random.default_rng(4)
    x = source.integers(-2, 3, (900, 6)).astype(np.float32)  # many ties and equal vectors
    x[~x.any(axis=1)] = 1
    x[300:600] = x[300]  # one vector on a third of the rows
    rows = [(int(i) - 100, v) for i, v in zip(source.permutation(900), x)]
    found = nb.nearest(frame(spark, rows), recall=1.1).collect()
    assert sorted(tuple(r) for r in found) == brute(rows)


def test_odd_rows(spark):
    good = [(i, [1.0 + i, 2.0, 3.0]) for i in range(30)]
    nan, inf = float("nan"), float("inf")
    odd = [(None, [1, 2, 3]), (40, None), (60, []), (80, [0, 0, 0]), (100, [1, None, 2]), (120, [nan, 1, 1]), (140, [inf, 1, 1])]
    odd += [(160, [1, 2]), (180, [5.0]), (0, [1.0, 2.0, 3.0]), (20, [22.0, 9.0, 9.0])]  # a repeated row, an id with two vectors
    found = nb.nearest(frame(spark, good + odd)).collect()
    assert sorted(tuple(r) for r in found) == brute(good)
    assert {r.query_id for r in found} == {0, 20}


@pytest.mark.parametrize("n", [0, 1, 2, 15])
def test_few_rows(spark, n):
    rows = [(20 * i, [1.0, float(i)]) for i in range(n)]
    found = nb.nearest(frame(spark, rows) if n else frame(spark, [(0, [1.0])]).where("false")).collect()
    assert sorted(tuple(r) for r in found) == brute(rows)
    assert len(found) == n * (n - 1)


def test_doubles_and_other_queries(spark):
    rows = [(i, [i / 7, 1 / (i + 1)]) for i in range(50)]
    source = spark.createDataFrame(rows, "name long, v array<double>")
    found = nb.nearest(source, k=3, queries=nb.F.col("vec_id") == 7, id_col="name", vector_col="v").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(found, key=lambda r: r["rank"])] == [(7, 1, 49), (7, 2, 48), (7, 3, 47)]


def test_cells():
    first, count, cells = nb._laid_out(np.array([10, 0, 50, 250, 60, 50, 1]), 100)
    assert cells == 6 and count.tolist() == [1, 1, 1, 3, 1, 1, 1]
    assert first.tolist() == [0, 0, 0, 1, 4, 5, 5]
    assert nb._laid_out(np.array([250]), 100) [2] == 3
