"""Approximate nearest neighbours: balanced parts of a neighbour graph, and a classifier that routes queries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from pathgauge.llm.common import hashed_sample, mix, settle

#: At most so many vectors, picked by a hash of their id, make the graph and teach the classifier.
SAMPLE = 16384
#: Parts of the graph; each has at least LEAST sampled vectors, so a small table has fewer.
PARTS, LEAST = 256, 32
#: Neighbours of a vector in the graph.
DEGREE = 20
#: Share of the true neighbours that the probed parts hold, on sampled vectors kept out of the training.
RECALL = 0.95
EPOCHS, BATCH, RATE = 12, 256, 0.01
#: Rows of a cell, which one task searches: between these, so that cells are as many as tasks.
CELL_ROWS = (2048, 131072)
_TILE = 1 << 22


def _directions(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def bisected(near: np.ndarray, parts: int) -> np.ndarray:
    """Part of each node of a neighbour graph (nodes x neighbours): ``parts``, a power of two, of equal size but for one.

    Every part is halved until there are enough. A half is what lies on one side
    of the median when a random value is smoothed along the edges again and
    again; then nodes of the two halves change places in pairs, those first that
    lose the most cut edges.
    """
    n = len(near)
    here = np.repeat(np.arange(n), near.shape[1])
    source, target = np.concatenate((here, near.ravel())), np.concatenate((near.ravel(), here))
    part, groups = np.zeros(n, np.int64), 1
    start_value = np.random.default_rng(1).standard_normal(n)
    while groups < parts:
        inner = part[source] == part[target]
        s, t = source[inner], target[inner]
        degree = np.maximum(np.bincount(s, minlength=n), 1)
        size = np.bincount(part, minlength=groups)
        value = start_value
        for _ in range(25):
            value = 0.5 * (value + np.bincount(s, value[t], minlength=n) / degree)
            value = value - (np.bincount(part, value, minlength=groups) / size)[part]
            value = value / (np.sqrt(np.bincount(part, value * value, minlength=groups) / size)[part] + 1e-12)
        order = np.lexsort((value, part))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - (np.cumsum(size) - size)[part[order]]
        half = (2 * rank >= size[part]).astype(np.int64)
        for _ in range(12):
            gain = np.bincount(s, np.where(half[s] == half[t], -1.0, 1.0), minlength=n)
            key = 2 * part + half
            count = np.bincount(key, minlength=2 * groups)
            first = np.cumsum(count) - count
            order = np.lexsort((-gain, key))
            rank[order] = np.arange(n) - first[key[order]]
            other = 2 * part + 1 - half
            paired = (rank < count[other]) & (rank < np.maximum(1, np.minimum(count[key], count[other]) // 8))
            partner = order[(first[other] + rank)[paired]]
            swap = np.flatnonzero(paired)[gain[paired] + gain[partner] > 0]
            if not len(swap):
                break
            half[swap] = 1 - half[swap]
        part, groups = 2 * part + half, 2 * groups
    return part


def _probabilities(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = _directions(x) @ weights[:-1] + weights[-1]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _shares(part: np.ndarray, near: np.ndarray, parts: int) -> np.ndarray:
    """Share of each node's neighbours in each part."""
    shares = np.zeros((len(near), parts))
    np.add.at(shares, (np.repeat(np.arange(len(near)), near.shape[1]), part[near].ravel()), 1 / near.shape[1])
    return shares


def train(x: np.ndarray, near: np.ndarray, parts: int, recall: float) -> tuple[np.ndarray, float]:
    """Weights of a softmax over parts, and the probability that a query's parts must have in sum.

    It learns from nine in ten vectors where their neighbours are (Adam, on
    directions); on the tenth the least sum is sought that holds ``recall`` of
    the neighbours, by the parts that the classifier itself puts them in.
    """
    dim, held = x.shape[1], np.arange(len(x)) % 10 == 9
    weights = np.zeros((dim + 1, parts))
    if parts == 1:
        return weights, 1.0
    shares = _shares(bisected(near, parts), near, parts)
    inputs = np.column_stack((_directions(x) * np.sqrt(dim), np.ones(len(x))))
    first, second, step = np.zeros_like(weights), np.zeros_like(weights), 0
    source, taught = np.random.default_rng(3), np.flatnonzero(~held)
    for epoch in range(EPOCHS):
        shuffled = source.permutation(taught)
        for k in range(0, len(shuffled), BATCH):
            some = shuffled[k : k + BATCH]
            z = inputs[some] @ weights
            z = np.exp(z - z.max(axis=1, keepdims=True))
            slope = inputs[some].T @ ((z / z.sum(axis=1, keepdims=True) - shares[some]) / len(some))
            step += 1
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope * slope
            rate = RATE * (1 - epoch / EPOCHS)
            weights -= rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights[:-1] *= np.sqrt(dim)
    own = np.concatenate([_probabilities(x[k : k + 4096], weights).argmax(axis=1) for k in range(0, len(x), 4096)])
    odds = _probabilities(x[held], weights)
    order = np.argsort(-odds, axis=1, kind="stable")
    odds = np.take_along_axis(odds, order, 1)
    before = odds.cumsum(axis=1) - odds
    caught = np.take_along_axis(_shares(own, near[held], parts), order, 1)
    low, high = 0.0, 1.0
    for _ in range(20):
        middle = (low + high) / 2
        enough = (caught * (before < middle)).sum(axis=1).mean() >= recall
        low, high = (low, middle) if enough else (middle, high)
    return weights, high


def _fitted(vectors: DataFrame, sample: int, parts: int, recall: float) -> tuple[np.ndarray, float] | None:
    """The graph of a sample, block by block in tasks, then the parts and the classifier in one."""
    spark = vectors.sparkSession
    picked = hashed_sample(vectors.withColumn("at", F.xxhash64("vec_id")), "at", sample).select("vector").toArrow()
    n = picked.num_rows
    if not n:
        return None
    x = _matrix(picked.column(0).combine_chunks())
    shared = spark.sparkContext.broadcast(x)
    degree = min(DEGREE, n - 1)
    most = max(1, min(parts, n // LEAST))
    groups = 1 << (most.bit_length() - 1)
    if groups == 1:
        return train(x, np.zeros((n, 0), np.int64), 1, recall)
    block = 512

    def graph(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        for batch in batches:
            for b in batch.column(0).to_pylist():
                rows = np.arange(b * block, min(n, (b + 1) * block))
                likeness = x[rows] @ x.T
                likeness[np.arange(len(rows)), rows] = -np.inf
                near = np.argpartition(-likeness, degree - 1, axis=1)[:, :degree].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([near.tobytes()], pa.binary())], ["block", "near"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for batch in batches:
            found.update(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        near = np.concatenate([np.frombuffer(found[b], np.int32) for b in sorted(found)]).reshape(n, degree)
        weights, mass = train(shared.value, near, groups, recall)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([mass])], ["weights", "mass"])

    blocks = -(-n // block)
    found = (
        spark.range(0, blocks, 1, min(blocks, spark.sparkContext.defaultParallelism))
        .mapInArrow(graph, "block long, near binary")
        .repartition(1)
        .mapInArrow(fit, "weights binary, mass double")
        .first()
    )
    return np.frombuffer(found["weights"], np.float64).reshape(x.shape[1] + 1, groups), found["mass"]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class _Cell:
    """Vectors of a cell by part; equal vectors of a part stand once with their lowest ids."""

    def __init__(self, part: np.ndarray, ids: np.ndarray, x: np.ndarray, keep: int) -> None:
        raw = np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * 8))).ravel()
        _, alike = np.unique(raw, return_inverse=True)
        order = np.lexsort((ids, alike, part))
        part, alike, ids = part[order], alike[order], ids[order]
        opens = np.concatenate(([True], (np.diff(part) != 0) | (np.diff(alike) != 0)))
        nth = np.arange(len(ids)) - np.maximum.accumulate(np.where(opens, np.arange(len(ids)), 0))
        kept = nth < keep
        self.ids = ids[kept]
        self.first = np.append(np.flatnonzero(nth[kept] == 0), len(self.ids))
        self.x = x[order[opens]]
        self.columns = np.ascontiguousarray(self.x.T)
        self.parts, begin = np.unique(part[opens], return_index=True)
        self.begin = np.append(begin, len(self.x))
        self.longest = np.linalg.norm(self.x, axis=1).max()

    def nearest(self, ids: np.ndarray, q: np.ndarray, probed: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query row, id, score) of the ``k`` nearest of each query among its probed parts."""
        keep = k + 1  # one may be the query itself
        rows = np.repeat(np.arange(len(q)), [len(p) for p in probed])
        wanted = np.concatenate(probed)
        by_part = np.argsort(wanted, kind="stable")
        rows, wanted = rows[by_part], wanted[by_part]
        # Products of blocks may differ in the last bits from the sums taken below.
        margin = 1e-12 * np.linalg.norm(q, axis=1) * self.longest
        best = np.full((len(q), keep), -np.inf)
        pairs = []
        for p, lo, hi in zip(self.parts, self.begin[:-1], self.begin[1:]):
            mine = rows[np.searchsorted(wanted, p) : np.searchsorted(wanted, p, "right")]
            step = max(1, _TILE // (hi - lo))
            for s in range(0, len(mine), step):
                some = mine[s : s + step]
                likeness = q[some] @ self.x[lo:hi].T
                top = likeness if hi - lo <= keep else np.partition(likeness, hi - lo - keep, axis=1)[:, -keep:]
                best[some] = np.partition(np.concatenate((best[some], top), axis=1), top.shape[1], axis=1)[:, -keep:]
                r, c = np.nonzero(likeness >= (best[some, 0] - margin[some])[:, None])
                pairs.append((some[r], lo + c, likeness[r, c]))
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        row, at, rough = (np.concatenate(x) for x in zip(*pairs))
        near = rough >= best[row, 0] - margin[row]
        row, at = row[near], at[near]
        score = np.zeros(len(row))
        for s in range(0, len(row), _TILE):
            r, a = row[s : s + _TILE], at[s : s + _TILE]
            for d in range(q.shape[1]):
                score[s : s + _TILE] += q[r, d] * self.columns[d, a]
        copies = self.first[at + 1] - self.first[at]
        row, score = np.repeat(row, copies), np.repeat(score, copies)
        found = self.ids[np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies) + np.repeat(self.first[at], copies)]
        other = found != ids[row]
        row, score, found = row[other], score[other], found[other]
        order = np.lexsort((found, -score, row))
        row, score, found = row[order], score[order], found[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        return row[nth < k], found[nth < k], score[nth < k]


def _laid_out(sizes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First cell and number of cells of each part, and all cells: a large part has several, small ones share one."""
    first, count = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    cell, filled = 0, 0
    for p, size in enumerate(sizes.tolist()):
        if filled and filled + size > rows:
            cell, filled = cell + 1, 0
        first[p] = cell
        if size > rows:
            count[p] = -(-size // rows)
            cell += int(count[p])
        else:
            filled += size
    return first, count, cell + (filled > 0)


def nearest(
    vectors: DataFrame,
    k: int = 20,
    queries: Column | None = None,
    sample: int = SAMPLE,
    parts: int = PARTS,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors of largest inner product found per query.

    ``queries`` is a condition on the id, by default that it is divisible by 20;
    a query's own id is no candidate. A bounded sample makes a graph of nearest
    neighbours that is cut into balanced parts; a classifier learns in which parts
    a vector's neighbours are. Every vector is indexed in its likeliest part. A
    query probes its likeliest parts until their probabilities add up to what
    gave ``recall`` on sampled vectors, and more if they hold no k candidates;
    what they hold is compared with it in full. Scores are sums in order of the
    components in double precision, equal for equal vectors; ties go to the
    smaller id.

    Parts of many vectors, as of one vector a third of the table repeats, are
    dealt out to several cells by id; a cell's vectors are held in one task
    (at most CELL_ROWS[1] of them), its queries stream past.

    Rows without an id, and vectors that are null, empty, zero or hold a null or
    a non-finite component take no part, nor do those of another length than the
    most frequent (of equals the greatest). Rows that share an id count once, with
    the least of their vectors. An empty table, or a single vector, gives no rows.
    """
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, score double"
    kind = vectors.schema[vector_col].dataType
    element = FloatType() if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else DoubleType()
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(ArrayType(element)).alias("vector"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        ~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0)
    )
    lengths = usable.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = lengths["dim"] if lengths else 0
    once = settle(usable.where(F.size("vector") == dim).groupBy("vec_id").agg(F.min("vector").alias("vector")))
    model = _fitted(once, sample, parts, recall)
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    weights, mass = model
    shared = spark.sparkContext.broadcast(weights)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = _probabilities(_matrix(batch.column(0)), shared.value).argmax(axis=1)
                part, count = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(count)], ["part", "rows"])

    counted = once.select("vector").mapInArrow(assign, "part int, rows long").groupBy("part").agg(F.sum("rows").alias("rows"))
    sizes = np.zeros(weights.shape[1], np.int64)
    for r in counted.collect():  # one row a part at most
        sizes[r["part"]] = r["rows"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_cell = int(np.clip(-(-sizes.sum() // tasks), *CELL_ROWS))
    first, count, cells = _laid_out(sizes, per_cell)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every vector to its cell, and every query to each cell of its probed parts, with these parts."""
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            odds = _probabilities(_matrix(batch.column(1)), shared.value)
            own = odds.argmax(axis=1)
            cell = first[own] + (mix(ids.view(np.uint64)) % count[own].astype(np.uint64)).astype(np.int64)
            asks = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False))
            order = np.argsort(-odds[asks], axis=1, kind="stable")
            sorted_odds = np.take_along_axis(odds[asks], order, 1)
            held = sizes[order]
            probed = (sorted_odds.cumsum(axis=1) - sorted_odds < mass) | (held.cumsum(axis=1) - held <= k)
            row, nth = np.nonzero(probed & (held > 0))
            part = order[row, nth]
            row, part, copies = np.repeat(row, count[part]), np.repeat(part, count[part]), count[part]
            at = first[part] + np.arange(len(part)) - np.repeat(np.cumsum(copies) - copies, copies)
            by_cell = np.lexsort((part, at, row))
            row, part, at = row[by_cell], part[by_cell], at[by_cell]
            opens = np.flatnonzero(np.concatenate(([True], (np.diff(row) != 0) | (np.diff(at) != 0)))) if len(row) else row
            source = np.concatenate((np.arange(len(ids)), asks[row[opens]]))
            offsets = np.concatenate((np.arange(len(ids)), len(ids) + opens, [len(ids) + len(part)]))
            columns = [
                pa.array(np.concatenate((cell, at[opens])).astype(np.int32)),
                pa.array(np.arange(len(source)) >= len(ids)),
                batch.column(0).take(pa.array(source)),
                batch.column(1).take(pa.array(source)),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate((own, part)).astype(np.int32))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "asks", "vec_id", "vector", "parts"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by cell, a cell's vectors before its queries."""
        current, held, index = None, [], None
        for batch in batches:
            cell = batch.column(0).to_numpy()
            asks = batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(cell) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cell)]):
                if lo == hi:
                    continue
                ids, x = batch.column(2).to_numpy()[lo:hi], _matrix(batch.column(3).slice(lo, hi - lo))
                own = batch.column(4).slice(lo, hi - lo)
                if cell[lo] != current:
                    current, held, index = cell[lo], [], None
                if not asks[lo]:
                    held.append((own.flatten().to_numpy(), ids, x))
                    continue
                if index is None:
                    if not held:
                        continue
                    index, held = _Cell(*(np.concatenate(c) for c in zip(*held)), k + 1), []
                ends = np.cumsum(own.value_lengths().to_numpy())[:-1]
                row, found, score = index.nearest(ids, x, np.split(own.flatten().to_numpy(), ends), k)
                columns = [pa.array(ids[row]), pa.array(found), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    asked = F.pmod("vec_id", F.lit(20)) == 0 if queries is None else queries
    element_name = "float" if isinstance(element, FloatType) else "double"
    placed = once.select("vec_id", "vector", F.coalesce(asked, F.lit(False)).alias("asks")).mapInArrow(
        place, f"cell int, asks boolean, vec_id long, vector array<{element_name}>, parts array<int>"
    )
    found = placed.repartitionById(cells, "cell").sortWithinPartitions("cell", "asks").mapInArrow(search, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
