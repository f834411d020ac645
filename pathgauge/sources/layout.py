"""Tables laid out by a key, so that what is joined or looked up by it is found together.

Two layouts. *Placed*: bucketed and sorted by the key; two tables placed by the
same key into as many buckets join, and are summed by it, without a shuffle.
*Ordered* (``store`` with ``blooms``, over rows in order of the key): row groups
hold narrow ranges of keys, so a filter on a few keys reads a few of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from pathgauge.sources import manifest
from pathgauge.sources.stages import stage_path

_NAME = "_layout.json"  # Spark's readers pass over names that begin so


def _table_name(path: str) -> str:
    return f"pathgauge_{manifest.digest(path)[:16]}"


def _open(spark: SparkSession, path: str, layout: dict, empty: bool = False) -> DataFrame:
    """The folder as a table of the session's catalog, which alone knows buckets; its data stay where they are."""
    name = _table_name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(layout["schema"]))
    parted = f"PARTITIONED BY (`{layout['partition_by']}`)" if layout["partition_by"] else ""
    place, by = path.replace("\\", "\\\\").replace("'", "\\'"), layout["by"]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"""CREATE TABLE {name} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') {parted}
        CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {layout["buckets"]} BUCKETS LOCATION '{place}'"""
    )
    if parted and not empty:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def read_placed(spark: SparkSession, path: str) -> DataFrame:
    """A placed table as ``store_placed`` left it; starts no job."""
    layout = manifest.read_json(spark, f"{path}/{_NAME}")
    if layout is None:
        raise FileNotFoundError(f"{path} holds no placed table")
    return _open(spark, path, layout)


def store_placed(
    df: DataFrame,
    name: str,
    *,
    by: str,
    buckets: int,
    partition_by: str | None = None,
    path: str | None = None,
    keep_other: bool = False,
) -> DataFrame:
    """Write ``df`` bucketed and sorted by one column and return the table as read back.

    Each task writes one bucket, so there is one file per bucket and partition.
    All rows of a key are in one task: it is for tables of few rows per key, such
    as sums. With ``keep_other`` only the partitions that ``df`` has rows for are
    replaced, and the number of buckets stays what it was.
    """
    spark = df.sparkSession
    target = path or stage_path(spark, name)
    layout = manifest.read_json(spark, f"{target}/{_NAME}") if keep_other else None
    fresh = layout is None
    if fresh:
        # Partition columns come last, as in the catalog.
        order = [c for c in df.columns if c != partition_by] + ([partition_by] if partition_by else [])
        schema = df.select(*order).schema.jsonValue()
        layout = {"schema": schema, "by": by, "buckets": buckets, "partition_by": partition_by}
        manifest.remove(spark, target)
    table = _open(spark, target, layout, empty=fresh)
    dealt = df.select(*table.columns).repartition(layout["buckets"], by)
    dealt.write.insertInto(_table_name(target), overwrite=True)
    manifest.write_json(spark, f"{target}/{_NAME}", layout)
    return _open(spark, target, layout)
