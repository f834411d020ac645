"""Benchmark items inside documents: pigeonhole pieces, then Myers' bit-parallel distance."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathgauge.llm.common import chunks, id_and_text

#: One edit is allowed for each so many characters of an item, so its pieces have about this length.
CHARS_PER_ERROR = 16
#: Shorter items are found from word border to word border only.
LEAST_CHARS = 20
#: The items are searched in blocks of about this many bytes, one pass over the documents each.
BLOCK_BYTES = 2 << 20


def plain(text: str | None) -> str:
    """Lower case, every run of white space one space."""
    return " ".join(text.lower().split()) if text else ""


def search(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of ``pattern`` to any part of ``text``, end of the first such part)."""
    m = len(pattern)
    equal: dict[str, int] = {}
    for i, c in enumerate(pattern):
        equal[c] = equal.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = mask, 0, m
    best, at = m, 0
    for j, c in enumerate(text, 1):
        same = equal.get(c, 0)
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        plus = down | (~(horizontal | up) & mask)
        minus = up & horizontal
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus <<= 1
        up = ((minus << 1) | ~(vertical | plus)) & mask
        down = plus & vertical & mask
        if score < best:
            best, at = score, j
    return best, at


# Scripts that set no spaces between words: every place is a border there.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _border(text: str, at: int) -> bool:
    """Whether no word goes on over place ``at``."""
    around = text[at - 1 : at + 1] if at else ""
    return len(around) < 2 or not around[0].isalnum() or not around[1].isalnum() or bool(_UNSPACED.search(around))


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, x in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (c != x))
    return row[-1]


def _between_borders(item: str, text: str, places: list[int], errors: int) -> tuple[int, int]:
    """(least distance, end) of the parts of ``text`` near ``places`` that begin and end at borders."""
    best, at = errors + 1, -1
    for place in sorted(set(places)):
        for begin in range(max(0, place - errors), place + errors + 1):
            if _border(text, begin):
                for end in range(begin + len(item) - errors, min(len(text), begin + len(item) + errors) + 1):
                    if _border(text, end) and (found := _distance(item, text[begin:end])) < best:
                        best, at = found, end
        if best == 0:
            break
    return best, at


class Matcher:
    """Items of one block, found in texts with at most ``len // chars_per_error`` edits each."""

    def __init__(self, items: list[tuple[int | None, str]], chars_per_error: int) -> None:
        self.items = [(i, t, len(t) // chars_per_error) for i, t in items]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item, errors) in enumerate(self.items):
            cuts = [len(item) * p // (errors + 1) for p in range(errors + 2)]
            for begin, end in zip(cuts, cuts[1:]):
                pieces.setdefault(item[begin:end], []).append((k, begin))
        self.pieces = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.pieces.add_word(piece, (len(piece), places))
        if pieces:
            self.pieces.make_automaton()

    def find(self, raw: str | None) -> list[tuple[int, int, int]]:
        """(item, distance, end in the plain text) of the closest place of every item found."""
        text = plain(raw)
        if not text or not self.items:
            return []
        starts: dict[int, list[int]] = {}
        for last, (length, places) in self.pieces.iter(text):
            for k, begin in places:
                starts.setdefault(k, []).append(last + 1 - length - begin)
        found = []
        for k, places in starts.items():
            _, item, errors = self.items[k]
            best, at, done = errors + 1, -1, -1
            if len(item) < LEAST_CHARS:
                best, at = _between_borders(item, text, places, errors)
                places = []
            for start in sorted(places):
                # A match of this piece begins within the error budget of ``start``.
                low, high = max(0, start - errors), min(len(text), start + len(item) + errors)
                if high <= done:
                    continue
                distance, end = search(item, text[low:high])
                done = high
                if distance < best:
                    best, at = distance, low + end
                if best == 0:
                    break
            if best <= errors:
                found.append((k, best, at))
        return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    """Searchable items, in blocks whose size doesn't grow with the benchmark."""
    items = id_and_text(benchmark, id_col, text_col).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // BLOCK_BYTES)
    for block in range(count):
        rows = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)) == block).collect()
        found = sorted({(r.doc_id, plain(r.text)) for r in rows}, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        yield [(i, t) for i, t in found if t]


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    chars_per_error: int = CHARS_PER_ERROR,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
) -> DataFrame:
    """(doc_id, item_id, distance, allowed, place): a row for each document and item it holds.

    Case and white space are evened out. An item may differ in one edit for each
    ``chars_per_error`` characters; it is cut into one piece more than that, so
    one piece must stand unchanged in any match, and Myers' distance is taken
    around each piece found. ``place`` is where the closest match ends in the
    evened-out text. Null and empty texts hold nothing; items under 20
    characters count from word border to word border only; repeated rows each give their rows. An empty
    table on either side gives no rows.
    """
    source, schema = id_and_text(docs, id_col, text_col), "doc_id long, item_id long, distance int, allowed int, place long"
    result = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark, item_col, text_col):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, chars_per_error)
            for batch in chunks(batches, "text"):
                rows = [
                    (doc_id, matcher.items[k][0], distance, matcher.items[k][2], place)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for k, distance, place in matcher.find(text)
                ]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance", "allowed", "place"])

        result = result.unionByName(source.mapInArrow(run, schema))
    return result


def without_benchmark(docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; same columns, no shuffle."""
    for items in _blocks(benchmark, "item_id", "text"):
        docs = docs.where(~_holds(docs.sparkSession.sparkContext.broadcast(items), chars_per_error)(F.col("text").cast("string")))
    return docs


def _holds(shared, chars_per_error: int):
    """Column function: whether a text holds one of the broadcast items."""

    @F.arrow_udf("boolean")
    def holds(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(shared.value, chars_per_error)
        for part in texts:
            yield pa.array([bool(matcher.find(text.as_py())) for text in part], pa.bool_())

    return holds
