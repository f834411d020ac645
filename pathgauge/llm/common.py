"""Helpers that several operators share: checkpoints, bounded text chunks, hashed words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathgauge.sources.stages import ensure_checkpoint_dir

#: Texts are worked on in pieces of about this many bytes, so that the arrays made from
#: them stay small whatever the batch holds; one longer text is a piece of its own.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def settle(df: DataFrame) -> DataFrame:
    """Run ``df`` once and keep its rows in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns of fixed names and types; whatever else ``docs`` has can't clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def hashed_sample(rows: DataFrame, hash_col: str, size: int) -> DataFrame:
    """At most ``size`` rows, those of the lowest hashes; ties are broken by the other columns.

    A share of about twice as many is cut out by hash first, so the rows that
    are put in order don't grow with the table.
    """
    share = min(1.0, 2 * size / max(1, rows.count()))
    upto = min(2**63 - 1, -(2**63) + int(share * 2**64))
    return rows.where(F.col(hash_col) <= upto).orderBy(hash_col, *[c for c in rows.columns if c != hash_col]).limit(size)


def in_fold(id_col: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a missing id counts as empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds == fold


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Every batch cut into runs of rows whose texts hold at most ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        total = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, a line feed after each, and where each begins (one more at the end)."""
    kind = pa.large_string()
    joined = pc.binary_join_element_wise(pc.fill_null(texts.cast(kind), ""), pa.scalar("", kind), pa.scalar("\n", kind))
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    _, offsets, data = joined.buffers()
    n = len(joined)
    bounds = np.frombuffer(offsets, np.int64)[joined.offset : joined.offset + n + 1] if n else np.zeros(1, np.int64)
    values = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if n else np.zeros(0, np.uint8)
    return values, bounds - bounds[0]


def byte_class(members: bytes) -> np.ndarray:
    """Table of 256 booleans."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Bytes of a word between white space (space, tab, line feed, vertical tab, form feed, return).
NOT_SPACE = ~byte_class(b" \t\n\v\f\r")


def runs(data: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where maximal runs of wanted bytes begin and end."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = wanted[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal spans have equal hashes wherever they stand.

    A polynomial in the bytes, taken as a difference of running sums, so the cost
    doesn't depend on the lengths of the spans.
    """
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def code_points_before(data: np.ndarray) -> np.ndarray:
    """Number of code points that begin before each byte offset (one more at the end)."""
    count = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=count[1:])
    return count


def list_array(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
