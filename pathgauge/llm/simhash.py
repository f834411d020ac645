"""SimHash near-duplicates: fingerprints, links by pigeonring filtering, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pathgauge.llm.common import chunks, id_and_text, settle, text_bytes
from pathgauge.llm.components import components

BITS = 64
SEED = 42
#: Ring of equal segments; a power of two keeps every segment whole bits.
SEGMENTS = 8
#: A bucket with more fingerprints than this is split further before its pairs are tried.
#: Not a cap: a split bucket holds at most 2 * 2 ** (BITS // SEGMENTS) by construction.
BUCKET = 512


def _fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [
        digest(joined[s:e], SEED) for s, e in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    ]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority).view(">i8")[0])


def _marked(source: DataFrame, shingle: int) -> DataFrame:
    """``source`` with the fingerprint of ``text`` as ``fp`` in place of it."""
    kept = [f for f in source.schema.fields if f.name != "text"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            data, bounds = text_bytes(batch.column("text"))
            raw = data.tobytes()
            found = [_fingerprint(raw[s:e], shingle) for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(found, pa.int64())], [*names, "fp"])

    return source.mapInArrow(run, StructType([*kept, StructField("fp", LongType())]))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) per row of ``docs``; fp is the 64-bit fingerprint as a long.

    Words are runs of bytes that aren't ASCII white space, A-Z lower-cased;
    shingles count as often as they occur. A null or empty text, or one without
    words, has fingerprint 0; fewer words than a shingle count as one shingle.
    """
    return _marked(id_and_text(docs, id_col, text_col), shingle)


def _rotated(fp: Column, start: Column) -> Column:
    """Bits of the ring read from segment ``start``."""
    by = (start * (BITS // SEGMENTS)).cast("int")
    turned = F.call_function("shiftleft", fp, by).bitwiseOR(F.call_function("shiftrightunsigned", fp, BITS - by))
    return F.when(start == 0, fp).otherwise(turned)


def _linked(rings: np.ndarray, distance: int, strict: int) -> np.ndarray:
    """Least index that each fingerprint of a bucket is linked to, straight or through others."""
    width = BITS // SEGMENTS
    differ = rings[:, None] ^ rings[None, :]
    chain = np.ones(differ.shape, bool)
    for length in range(strict + 1, SEGMENTS):  # the first ``strict`` segments are the bucket's key
        chain &= np.bitwise_count(differ >> np.uint64(BITS - length * width)) <= length * distance // SEGMENTS
    left, right = np.nonzero(chain)
    near = np.bitwise_count(differ[left, right]) <= distance
    left, right = left[near], right[near]
    label = np.arange(len(rings))
    while True:
        lower = label.copy()
        np.minimum.at(lower, left, label[right])
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def links(distinct: DataFrame, distance: int = 2) -> DataFrame:
    """(a, b) fingerprints of one component each, enough to connect all within ``distance`` bits.

    Pigeonring: the 64 bits are a ring of 8 segments. If two fingerprints differ
    in at most d bits, some start exists from which every chain of l consecutive
    segments differs in at most l*d/8 bits. The chains whose budget is below one
    bit must be equal, and are the key that pairs must share; the longer chains
    are tried in a bucket before the whole distance.

    A bucket with many fingerprints (near copies of one text) is dealt out again:
    the chain of 7 segments may hold one difference only, so fingerprints are
    grouped by that chain with one of its free bits left out. Such a group can't
    hold more than 512, hence no group of any size is compared pair by pair, and
    within a bucket a link to the least member stands for all.
    """
    if distance != 2:
        raise ValueError("large buckets are split exactly for 2 differing bits only")
    width = BITS // SEGMENTS
    strict = next(n for n in range(SEGMENTS) if (n + 1) * distance >= SEGMENTS)
    keyed = (
        distinct.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))))
        .withColumn("ring", _rotated(F.col("fp"), F.col("start")))
        .select("start", "ring", F.call_function("shiftrightunsigned", "ring", F.lit(BITS - strict * width)).alias("key"))
    )
    sizes = settle(keyed.groupBy("start", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    met = keyed.join(sizes, ["start", "key"])
    # In the chain of all but one segment at most one bit differs; leave out one each time.
    rest = F.call_function("shiftrightunsigned", "ring", F.lit(width))
    free = (SEGMENTS - 1 - strict) * width
    left_out = F.transform(
        F.sequence(F.lit(0), F.lit(free - 1)),
        lambda bit: F.struct(bit.alias("bit"), rest.bitwiseAND(F.lit(-1).cast("long").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))).alias("rest")),
    )
    whole = F.array(F.struct(F.lit(-1).alias("bit"), F.col("key").alias("rest")))
    buckets = (
        met.withColumn("part", F.explode(F.when(F.col("size") > BUCKET, left_out).otherwise(whole)))
        .groupBy("start", "part")
        .agg(F.collect_list("ring").alias("rings"))
        .where(F.size("rings") > 1)
        .select("start", "rings")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            starts, lists = batch.column(0).to_numpy(), batch.column(1)
            bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            for start, lo, hi in zip(starts, bounds[:-1], bounds[1:]):
                rings = flat[lo:hi]
                label = _linked(rings, distance, strict)
                moved = np.flatnonzero(label != np.arange(len(rings)))
                by = np.uint64(width * int(start))
                fps = (rings >> by) | (rings << ((np.uint64(BITS) - by) % np.uint64(BITS))) if start else rings
                a.append(fps[moved])
                b.append(fps[label[moved]])
            if a:
                columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return buckets.mapInArrow(run, "a long, b long")


def _rooted(nodes: DataFrame, distance: int) -> DataFrame:
    """``nodes`` (one per fp) with ``root``, the least fingerprint of their component."""
    roots = components(links(nodes.select("fp"), distance), "a", "b").withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_components(
    docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest
    doc_id that can be reached over links of at most ``distance`` differing bits.
    Equal fingerprints are one node, so copies cost one row each and no pairs.
    Repeated rows each give a row; a null doc_id is kept and never chosen as the
    component's id unless a component has no other. An empty table gives none.
    """
    marked = settle(fingerprints(docs, shingle, id_col, text_col))
    nodes = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("size")))
    rooted = settle(_rooted(nodes, distance))
    named = settle(rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("size").alias("rows")).where("rows > 1"))
    labels = settle(rooted.join(named, "root").select("fp", "component_id"))
    return marked.join(labels, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_first(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of its smallest doc_id.

    Nulls come last; rows that share that id keep the one with the least text
    hash, and of rows equal in both the least hash of all columns decides.
    Whatever else has the same id, or none, doesn't matter.
    """
    marked = settle(_marked(id_and_text(docs).withColumn("text_hash", F.xxhash64("text")), shingle))
    first = F.struct(F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("text_hash").alias("_hash"))
    nodes = settle(marked.groupBy("fp").agg(F.min(first).alias("first")))
    kept = _rooted(nodes, distance).groupBy("root").agg(F.min("first").alias("first")).select("first.*")

    doc_id = F.col("doc_id").cast("long")
    hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = (
        docs.select(
            doc_id.isNull().alias("_none"),
            F.coalesce(doc_id, F.lit(0)).alias("_id"),
            F.xxhash64(F.col("text").cast("string")).alias("_hash"),
            F.xxhash64(*hashed).alias("_order"),
            F.struct(*docs.columns).alias("_row"),
        )
        .groupBy("_none", "_id", "_hash")
        .agg(F.min_by("_row", "_order").alias("_row"))
    )
    return rows.join(kept, ["_none", "_id", "_hash"], "left_semi").select("_row.*")
