"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathgauge.llm.common import settle


def _star(pairs: DataFrame, *, large: bool) -> DataFrame:
    """Hang each node's neighbours onto its least neighbour.

    A large star moves the greater neighbours, a small star the lesser ones and
    the node itself. The least neighbours are written before they are joined, so
    that both sides of the join are plain shuffles and a hub with a great many
    neighbours is split over tasks.
    """
    if large:
        pairs = pairs.unionByName(pairs.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = settle(pairs.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least")))
    met = pairs.join(least, "node")
    if large:
        moved = met.where("root > node").select(F.col("root").alias("node"), F.col("least").alias("root"))
    else:
        moved = met.where("root > least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        moved = moved.unionByName(least.select("node", F.col("least").alias("root")))
    return moved.where("node > root").distinct()


def _digest(pairs: DataFrame) -> tuple:
    mixed = F.xxhash64("node", "root")
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.bit_xor(F.shiftright(mixed, 7) * 31)).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge and isn't itself the least of its component.

    Each round is a large and a small star over the edges; the number of rounds
    grows with the logarithm of the longest path. Nothing but a digest of the
    edges reaches the driver. Loops and repeated edges are allowed.
    """
    pairs = settle(
        edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).where("node > root").distinct()
    )
    seen = _digest(pairs)
    while True:
        pairs = settle(_star(settle(_star(pairs, large=True)), large=False))
        now = _digest(pairs)
        if now == seen:
            return pairs
        seen = now
