"""Stage tables: written once, read by every later stage.

They live in the shared folder that ``spark.checkpoint.dir`` names, so a lost
executor costs its running tasks but never a stage that is already written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for stage tables: the cluster's checkpoint folder, or beside a local master's tables."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_pathgauge"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def _own_stages(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stages/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, name: str) -> str:
    """A folder no other stage uses, among those of this application."""
    return f"{_own_stages(spark)}/{uuid.uuid4().hex}/{name}"


def remove_stages(spark: SparkSession) -> None:
    """Delete what this application has stored without a path of its own, checkpoints too; for the end of a run."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    # Spark's checkpoint folder is one that it made for this application alone.
    for name in (_own_stages(spark), spark.sparkContext.getCheckpointDir()):
        if name:
            folder = jvm.org.apache.hadoop.fs.Path(name)
            folder.getFileSystem(conf).delete(folder, True)


def store(
    df: DataFrame,
    name: str,
    *,
    partition_by: str | None = None,
    path: str | None = None,
    keep_other: bool = False,
    blooms: Sequence[str] = (),
    row_group_bytes: int | None = None,
) -> DataFrame:
    """Write ``df`` as Parquet and return the table as read back.

    With ``keep_other`` only the partitions that ``df`` has rows for are replaced.
    Row groups carry a Bloom filter of each column in ``blooms``, as large as its
    values need; with them, and with the ranges of a column that rows are in order
    of, a scan passes over row groups that hold none of the values asked for.
    """
    spark = df.sparkSession
    target = path or stage_path(spark, name)
    writer = df.write.mode("overwrite" if path else "errorifexists")
    if keep_other:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    for column in blooms:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if blooms:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(target)
    return spark.read.schema(df.schema).parquet(target)
