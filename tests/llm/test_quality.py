"""Quality scores: the training rule against a plain one, held-out accuracy, edge cases."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pyarrow as pa

from llm_fixtures import docs  # noqa: F401
from pathgauge.llm import quality as q


def plain_ftrl(rows, epochs):
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0)) <= q.L1:
            return 0.0
        return -(z[k] - math.copysign(q.L1, z[k])) / ((q.BETA + math.sqrt(n[k])) / q.ALPHA + q.L2)

    for _ in range(epochs):
        for label, x in rows:
            w = {k: weight(k) for k in x}
            p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
            for k, v in x.items():
                g = (p - label) * v
                sigma = (math.sqrt(n.get(k, 0) + g * g) - math.sqrt(n.get(k, 0))) / q.ALPHA
                z[k] = z.get(k, 0) + g - sigma * w[k]
                n[k] = n.get(k, 0) + g * g
    return {k: weight(k) for k in z}


def test_training_rule():
    source = random.Random(2)
    rows = []
    for _ in range(60):
        keys = source.sample(range(30), 5)
        rows.append((source.randrange(2), {k: source.random() for k in keys}))
    found = q.ftrl([(y, np.array(list(x)), np.array(list(x.values()))) for y, x in rows], epochs=2)
    expected = plain_ftrl([(y, {**x, q.BUCKETS: 1.0}) for y, x in rows], 2)
    for k, w in expected.items():
        assert math.isclose(found[k], w, abs_tol=1e-9)
    assert np.count_nonzero(found) <= len(expected)


def test_score_is_the_sparse_product():
    weights = np.random.default_rng(1).normal(size=q.BUCKETS + 1)
    texts = pa.array(["a b a", None, "", "one", "x y z " * 400, "É ß\tq\x0bq"])
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array([1] * 6), texts, pa.array(range(6))], ["at", "label", "text", "label_id"])
    (features,) = q._features(iter([batch]))
    for k, score in enumerate(q._scores(texts, weights)):
        bucket, value = features.column(2)[k].as_py(), features.column(3)[k].as_py()
        logit = weights[-1] + sum(weights[b] * v for b, v in zip(bucket, value))
        assert math.isclose(score, 1 / (1 + math.exp(-max(-60, min(60, logit)))), rel_tol=1e-4, abs_tol=1e-9)


def sample(spark):
    source = random.Random(8)
    rows = []
    for k in range(600):
        good = k % 3 > 0
        words = [f"w{source.randrange(300)}" for _ in range(source.randrange(5, 60))]
        rows.append((k, " ".join(words if good else [w.upper() + "!!" for w in words]), int(good)))
    return rows


def test_held_out(spark, docs):
    rows = sample(spark)
    extra = [(9000, None), (9001, ""), (9002, "w1 w2"), (9002, "w1 w2"), (None, "w3 w4")]
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    frame = docs(*[r[:2] for r in rows], *extra)
    found = q.quality_scores(frame, labels).collect()
    assert len(found) == len(rows) + len(extra)
    by_id = {r.doc_id: r for r in found}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert [i for i, _ in held] == [i for i, _, _ in rows if by_id[i].held_out]
    assert sum(by_id[i].predicted == y for i, y in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert by_id[9000].score == by_id[9001].score
    # Held-out labels teach nothing: turning them round changes no score.
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality")
    again = {r.doc_id: r.score for r in q.quality_scores(frame, turned).collect()}
    assert again == {i: r.score for i, r in by_id.items()}


def test_no_labels_and_empty(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in q.quality_scores(docs((1, "a b")), labels).collect()] == [0.5]
    assert q.quality_scores(docs((1, "a")).where("false"), labels).collect() == []


def test_an_id_on_very_many_rows_teaches_once(docs):
    rows = [(k, ("good words here " if k % 2 else "bad bad 77 ") * (3 + k % 5)) for k in range(60)]
    labels = docs((1, "")).sparkSession.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    plain = q.train(docs(*rows), labels)
    repeated = docs(*rows).unionByName(docs(*[rows[3]] * 400))
    again = q.train(repeated, labels.unionByName(labels.where("doc_id = 3")).unionByName(labels))
    assert np.array_equal(plain, again)
