"""Text quality: logistic regression over hashed word n-grams, trained by FTRL-proximal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathgauge.llm.common import (
    NOT_SPACE,
    byte_class,
    chunks,
    hash_spans,
    hashed_sample,
    id_and_text,
    in_fold,
    mix,
    runs,
    text_bytes,
)

#: Weights; an n-gram's hash picks one.
BUCKETS = 1 << 18
#: At most so many labelled texts train the model, picked by a hash of their id.
SAMPLE = 6000
EPOCHS = 4
#: FTRL-proximal: learning rate, its smoothing, and the two regularisation strengths.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
#: An n-gram's value is its share of the text's n-grams times this.
SCALE = 6.0

_KIND = np.full(256, 4, np.uint64)  # other marks
for _k, _members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789")):
    _KIND[byte_class(_members)] = _k
_KIND[128:] = 3


def _grams(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every n-gram: words, word pairs, word shapes, shape pairs, repeats.

    A shape says which kinds of characters a word begins and ends with and about
    how long it is; a pair of shapes also says whether the two words are equal.
    A repeat is a pair of words of which only that much is told.
    """
    data, bounds = text_bytes(texts)
    starts, ends = runs(data, NOT_SPACE)
    text = np.searchsorted(bounds, starts, "right") - 1
    words = hash_spans(data, starts, ends)
    last = data[ends - 1]
    second = data[np.minimum(starts + 1, ends - 1)]
    before_last = data[np.maximum(ends - 2, starts)]
    size = np.minimum(np.log2(ends - starts + 1).astype(np.uint64), np.uint64(6))
    tail = np.where(_KIND[last] == 4, last, _KIND[last]).astype(np.uint64)
    shape = _KIND[data[starts]]
    for part in (_KIND[second], tail, (before_last == last).astype(np.uint64), size):
        shape = shape * np.uint64(257) + part
    shape = mix(shape + np.uint64(1))
    pair = np.flatnonzero(text[1:] == text[:-1]) if len(text) else np.zeros(0, np.int64)
    again = (words[pair] == words[pair + 1]).astype(np.uint64) if len(pair) else np.zeros(0, np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    found = [
        (text, mix(words + np.uint64(1))),
        (text[pair], mix(words[pair] * odd + words[pair + 1])),
        (text, mix(shape + np.uint64(3))),
        (text[pair], mix(shape[pair] * odd + shape[pair + 1] * np.uint64(3) + again)),
        (text[pair], mix(again + np.uint64(11))),
    ]
    return [(t, (h >> np.uint64(64 - 18)).astype(np.int64)) for t, h in found]


def _scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Probability of label 1 per text: one sparse dot product each."""
    n = len(texts)
    total = np.full(n, weights[-1])
    for text, bucket in _grams(texts):
        count = np.bincount(text, minlength=n)
        total += SCALE * np.bincount(text, weights[bucket], minlength=n) / np.maximum(count, 1)
    return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each labelled text as buckets and values."""
    for batch in chunks(batches, "text"):
        n = batch.num_rows
        keys, values = [], []
        for text, bucket in _grams(batch.column(2)):
            key, count = np.unique(text * BUCKETS + bucket, return_counts=True)
            keys.append(key)
            values.append(SCALE * count / np.bincount(text, minlength=n)[key // BUCKETS])
        key, value = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        cuts = np.searchsorted(key, np.arange(n + 1) * BUCKETS).astype(np.int32)
        columns = [
            batch.column(0),
            batch.column(1),
            pa.ListArray.from_arrays(pa.array(cuts), pa.array((key % BUCKETS).astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(cuts), pa.array(value.astype(np.float32))),
            batch.column(3),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["at", "label", "bucket", "value", "label_id"])


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes over (label, buckets, values); the last weight is the bias.

    A bucket may come up twice in a row (an n-gram of each kind); both add up.
    """
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weight(k: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[k]) * np.maximum(np.abs(z[k]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[k])) / ALPHA + L2)

    prepared = []
    for label, bucket, value in rows:
        k, place = np.unique(np.append(bucket, BUCKETS), return_inverse=True)
        prepared.append((label, k, np.bincount(place, np.append(value, 1.0))))
    for _ in range(epochs):
        for label, k, x in prepared:
            w = weight(k)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -60, 60)))
            g = (p - label) * x
            sigma = (np.sqrt(n[k] + g * g) - np.sqrt(n[k])) / ALPHA
            z[k] += g - sigma * w
            n[k] += g * g
    return weight(np.arange(BUCKETS + 1))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        at, label = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i in range(batch.num_rows):
            rows.append((at[i], label[i], batch.column(2)[i].values.to_numpy(), batch.column(3)[i].values.to_numpy()))
    rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
    weights = ftrl([r[1:] for r in rows])
    yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], ["weights"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from a bounded sample of labelled texts.

    ``sample`` label rows with a known quality are picked by a hash of their id.
    Their n-grams are counted where the texts are; one task takes the steps, over
    no more than ``sample`` rows of at most BUCKETS values: an id counts once, with
    its greatest label and, of several texts, that of the least hash. Without
    labels all weights are 0.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("label"))
        .where("label is not null and label_id is not null")
        .groupBy("label_id")
        .agg(F.max("label").alias("label"))
        .withColumn("label_hash", F.xxhash64("label_id"))
    )
    picked = hashed_sample(known, "label_hash", sample)
    source = (
        id_and_text(docs)
        .join(F.broadcast(picked), F.col("doc_id") == F.col("label_id"))
        .select(F.xxhash64(F.xxhash64("doc_id"), "text").alias("at"), "label", "text", "label_id")
    )
    found = (
        source.mapInArrow(_features, "at long, label int, bucket array<int>, value array<float>, label_id long")
        .groupBy("label_id")
        .agg(F.min_by(F.struct("at", "label", "bucket", "value"), "at").alias("row"))
        .select("row.*")
        .repartition(1)
        .mapInArrow(_train, "weights binary")
        .first()
    )
    return np.frombuffer(found["weights"], np.float64) if found else np.zeros(BUCKETS + 1)


def quality_scores(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3
) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    Learned from labels outside fold ``held_out`` (crc32 of the id as text);
    scores depend on the text alone, so equal texts score alike. Null and empty
    texts score what the bias gives. Repeated rows each give a row; without labels
    every score is 0.5.
    """
    weights = train(docs, labels.where(~in_fold("doc_id", folds, held_out)))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            score = pa.array(_scores(batch.column(2), shared.value))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), score], ["doc_id", "held_out", "score"])

    source = id_and_text(docs).select("doc_id", in_fold("doc_id", folds, held_out).alias("held_out"), "text")
    scored = source.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
