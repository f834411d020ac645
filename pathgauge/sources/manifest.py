"""Stage tables that are kept from one run to the next while nothing they were made from has changed.

A stage's manifest says what it was made from: input files with size and time,
the manifests of earlier stages, and the parameters it depends on. It is written
last, into the stage's folder, so a stage that was cut short has none.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: To be raised when a stage's meaning changes, so that tables of older code are made again.
VERSION = 2
_NAME = "_manifest.json"  # Spark's readers pass over names that begin so


def digest(content) -> str:
    return hashlib.sha256(json.dumps(content, sort_keys=True, default=str).encode()).hexdigest()


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _listed(spark: SparkSession, folder: str) -> list[list]:
    """(path below the folder, size) of every file that holds data."""
    files, at = _hadoop(spark, folder)
    if not files.exists(at):
        return []
    found, top = [], files.getFileStatus(at).getPath().toString()
    entries = files.listFiles(at, True)
    while entries.hasNext():
        entry = entries.next()
        name = entry.getPath().toString()[len(top) + 1 :]
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            found.append([name, entry.getLen()])
    return sorted(found)


def identity(df: DataFrame) -> str | None:
    """What ``df`` reads and does to it: its files with size and time, and its plan. None if it reads no files.

    Starts no job. A table made of rows in memory can't be told from another, so
    what depends on one is always made again.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    names = sorted(df.inputFiles())
    if not names or any(mark in plan.toString() for mark in ("LogicalRDD", "LocalRelation")):
        return None
    jvm = spark.sparkContext._jvm
    found: dict[str, list] = {}
    for folder in sorted({name.rsplit("/", 1)[0] for name in names}):
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f"{folder}/"))
        for status in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at):
            found[status.getPath().toUri().getPath()] = [status.getLen(), status.getModificationTime()]
    read = [[name, found[unquote(urlsplit(name).path)]] for name in names]
    return digest([plan.canonicalized().toString(), df.schema.json(), read])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds; none there is no error."""
    files, at = _hadoop(spark, path)
    files.delete(at, True)


def forget(spark: SparkSession, path: str) -> None:
    """Remove a stage's manifest, before the stage changes in part."""
    remove(spark, f"{path}/{_NAME}")


def read_json(spark: SparkSession, path: str) -> dict | None:
    """Content of a small file, None if there is none."""
    files, at = _hadoop(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, content: dict) -> None:
    files, at = _hadoop(spark, path)
    stream = files.create(at, True)
    try:
        stream.write(json.dumps(content).encode())
    finally:
        stream.close()


def kept(
    spark: SparkSession,
    path: str,
    made_from: Mapping[str, object],
    make: Callable[[], DataFrame],
    reopen: Callable[[], DataFrame] | None = None,
) -> tuple[DataFrame, str | None]:
    """The stored table, made anew unless its manifest and files agree; and what a later stage takes as its identity.

    ``make`` writes the table to ``path`` and returns it; ``reopen`` reads one that
    isn't plain Parquet. ``made_from`` names what
    it depends on; if any of that is None, it is made each time, and so is
    what depends on it.
    """
    known = None if any(v is None for v in made_from.values()) else digest([VERSION, dict(made_from)])
    there = read_json(spark, f"{path}/{_NAME}") if known else None
    if there and there["made_from"] == known and there["files"] == _listed(spark, path):
        if reopen:
            return reopen(), there["identity"]
        schema = StructType.fromJson(there["schema"])
        return spark.read.schema(schema).parquet(path), there["identity"]
    table = make()
    if known is None:
        forget(spark, path)
        return table, None
    files = _listed(spark, path)
    own = digest([known, files])
    content = {"made_from": known, "identity": own, "files": files, "schema": table.schema.jsonValue()}
    write_json(spark, f"{path}/{_NAME}", content)
    return table, own
