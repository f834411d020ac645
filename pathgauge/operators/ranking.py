"""Exact rank over large groups without putting a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pathgauge.sources.stages import ensure_checkpoint_dir


def average_rank_desc(df: DataFrame, group: str, score: str, tie_break: str, rank: str = "rank") -> DataFrame:
    """Rank within ``group`` by falling score; ties share their mean position.

    A missing score has no rank, but its row counts as standing ahead of every
    known score, so that ranks of n rows run up to n.

    A plain window over ``group`` would sort all its rows in one task. Here the
    rows are range-partitioned by (group, score, tie_break), which also spreads
    one very frequent score over several partitions, and each row's partition
    number is fixed by a reliable checkpoint. Ranks are then local counts plus
    two tables that hold at most a few rows per partition: rows in earlier
    partitions, and scores that a partition shares with its neighbours (only
    its first and last score can be shared).
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(F.col(group), F.col(score).desc_nulls_first(), F.col(tie_break))
        .withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )

    in_part = Window.partitionBy("_part", group)
    local = (
        placed.withColumn("_ahead", F.rank().over(in_part.orderBy(F.col(score).desc_nulls_first())) - 1)
        .withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy("_part", group, score)))
    )

    parts = placed.groupBy("_part", group).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(score).alias("_hi"), F.min(score).alias("_lo")
    )
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", group, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))

    # Rows of a partition's first and last score; both may reach into others.
    edge_counts = (
        placed.join(F.broadcast(parts.select("_part", group, "_hi", "_lo")), ["_part", group])
        .where((F.col(score) == F.col("_hi")) | (F.col(score) == F.col("_lo")))
        .groupBy("_part", group, score)
        .agg(F.count(F.lit(1)).alias("_edge"))
    )
    same_score = Window.partitionBy(group, score)
    edges = edge_counts.select(
        "_part",
        group,
        score,
        F.sum("_edge").over(same_score).alias("_ties"),
        F.coalesce(
            F.sum("_edge").over(same_score.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_ties_before"),
    )

    ahead = F.col("_before") - F.coalesce("_ties_before", F.lit(0)) + F.col("_ahead")
    ties = F.coalesce("_ties", "_same")
    return (
        local.join(F.broadcast(offsets), ["_part", group])
        .join(F.broadcast(edges), ["_part", group, score], "left")
        .withColumn(rank, F.when(F.col(score).isNotNull(), ahead + (ties + 1) / F.lit(2.0)))
        .select(*df.columns, rank)
    )
