"""Periodic runs of words: catchers over power-of-two blocks find squares, which merge into runs."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathgauge.llm.common import NOT_SPACE, chunks, id_and_text, mix, runs, text_bytes

#: A run has at least so many words, and twice its period.
LEAST = 12
#: Comparisons made at once.
_TILE = 1 << 22
_STEP = 16


def block_of(period: int, least: int = LEAST) -> int:
    """Length of the blocks whose catchers look for squares of ``period``.

    A run of that period has max(least, 2 * period) - period words in a row that
    come again a period later; the largest power of two is taken of which any
    such stretch holds a whole aligned block.
    """
    again = max(least - period, period)
    return 1 << ((again + 1) // 2).bit_length() - 1


def _ranges(block: int, least: int) -> list[tuple[int, int]]:
    """Periods that belong to blocks of this length, as (first, last) ranges."""
    if block > least:
        return [(2 * block - 1, 4 * block - 2)]
    own = np.array([q for q in range(1, 4 * block - 1) if block_of(q, least) == block], np.int64)
    if not len(own):
        return []
    cuts = np.flatnonzero(np.diff(own) > 1)
    return list(zip(own[np.append(0, cuts + 1)].tolist(), own[np.append(cuts, len(own) - 1)].tolist()))


def _advance(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """First place from ``at`` in direction ``step`` whose word isn't the one a period later."""
    at = at.copy()
    live = np.arange(len(at))
    reach = step * np.arange(_STEP)
    while len(live):
        place = at[live, None] + reach
        inside = (place >= 0) & (place + period[live, None] < len(words))
        place = np.where(inside, place, 0)
        same = inside & (words[place] == words[np.where(inside, place + period[live, None], 0)])
        count = np.where(same.all(axis=1), _STEP, same.argmin(axis=1))
        at[live] += step * count
        live = live[count == _STEP]
    return at


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in ``words``, sorted by start, then period.

    ``words`` are numbers; texts stand one after the other, longest first, each
    with a number after it that occurs once; ``sizes`` are their words. For every
    completed block of 2, 4, 8, ... words a catcher follows the text: the word
    appended ``period`` after the block's last completes the suffix that is
    compared with the block, for each period of the block's range. The catchers
    of one length advance in lockstep over all texts. Blocks in a row that are
    caught at one period are one stretch, extended word by word to either side;
    if it holds a square it is a run, unless the same stretch has a shorter period.

    A catch inside a known run of period at most the block is left out: what has a
    word stretch with both periods in it has their common divisor as period.
    """
    found = [np.zeros((3, 0), np.int64)]
    total = np.concatenate(([0], np.cumsum(sizes + 1)))
    hashes, block = mix(words.view(np.uint64) + np.uint64(1)), 1
    while True:
        ranges = _ranges(block, least)
        smallest = min((first for first, _ in ranges), default=block)
        # Texts that are too short for a run of this level's periods drop out for good.
        n = int(total[np.searchsorted(-sizes, -max(least, 2 * smallest), "right")])
        if n < block:
            break
        words, hashes = words[:n], hashes[: max(0, n - block + 1)]
        begin = np.arange(0, len(hashes), block)
        known = np.concatenate(found, axis=1)
        known = known[:, (known[2] <= block) & (known[0] < n)]
        reach = np.zeros(n + 1, np.int64)
        np.maximum.at(reach, known[0], known[1])
        reach = np.maximum.accumulate(reach)[begin]
        for first, last in ranges:
            width = last - first + 1
            padded = np.concatenate((hashes, np.zeros(last + block, np.uint64)))
            later = np.lib.stride_tricks.sliding_window_view(padded, width)[first::block]
            caught_block, caught_period = [], []
            rows = max(1, _TILE // width)
            for k in range(0, len(begin), rows):
                at = begin[k : k + rows]
                b, q = np.nonzero(later[k : k + len(at)] == hashes[at][:, None])
                q = q + first
                fresh = reach[k + b] < at[b] + q + block
                caught_block.append(k + b[fresh])
                caught_period.append(q[fresh])
            b, q = np.concatenate(caught_block), np.concatenate(caught_period)
            if not len(b):
                continue
            order = np.lexsort((b, q))
            b, q = b[order], q[order]
            opens = np.concatenate(([True], (np.diff(b) != 1) | (np.diff(q) != 0)))
            closes = np.append(opens[1:], True)
            period = q[opens]
            start = _advance(words, b[opens] * block - 1, period, -1) + 1
            end = _advance(words, (b[closes] + 1) * block, period, 1) + period
            whole = end - start >= np.maximum(least, 2 * period)
            found.append(np.stack((start, end, period))[:, whole])
        hashes = mix(hashes[: len(hashes) - block] * np.uint64(0x9E3779B97F4A7C15) + hashes[block:]) if len(hashes) > block else hashes[:0]
        block *= 2
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    shortest = np.concatenate(([True], (np.diff(start) != 0) | (np.diff(end) != 0))) if len(start) else np.zeros(0, bool)
    start, end, period = start[shortest], end[shortest], period[shortest]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal words have equal numbers."""
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    packed = data[NOT_SPACE[data]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def echo(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place: by the id's crc32 one text in ten repeats its last part.

    None if nothing changes, as for a row without an id.
    """
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % p)


def word_runs(
    docs: DataFrame,
    least: int = LEAST,
    order: Callable[[int | None, int], np.ndarray | None] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, runs, collapsed) per row of ``docs``.

    Words are runs of anything but ASCII white space, numbered from 0. A run is a
    stretch of at least ``least`` words and two periods whose words equal those a
    period later, that can't be longer, by its smallest period; ``runs`` holds
    (start, length, period) by start, then period. ``collapsed`` joins by one
    space the words that no run holds after its first period. ``order`` may say
    which word of a text (by its id and number of words) stands at each place.

    A null text has no words, no runs and an empty ``collapsed``, like an empty one;
    repeated rows each give a row; an empty table gives none. A text is read as a
    whole, in about 25 times its size.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            ids = batch.column(0).to_pylist()
            data, bounds = text_bytes(batch.column(1))
            starts, ends = runs(data, NOT_SPACE)
            first = np.searchsorted(starts, bounds)  # of each text, and the end
            sizes = np.diff(first)
            source = np.arange(len(starts))
            if order:
                for k in np.flatnonzero(sizes).tolist():
                    if (places := order(ids[k], int(sizes[k]))) is not None:
                        source[first[k] : first[k + 1]] = first[k] + places
            number = _word_numbers(data, starts, ends)[source] if len(starts) else np.zeros(0, np.int64)

            # Longest text first, a number of its own after each.
            longest = np.argsort(-sizes, kind="stable")
            place = np.zeros(len(sizes), np.int64)
            place[longest] = np.concatenate(([0], np.cumsum(sizes[longest] + 1)))[:-1]
            laid = np.empty(len(starts) + len(sizes), np.int64)
            laid[place + sizes] = len(starts) + np.arange(len(sizes))
            shift = np.repeat(place - first[:-1], sizes)
            laid[np.arange(len(starts)) + shift] = number
            start, end, period = find_runs(laid, sizes[longest], least)
            text = longest[np.searchsorted(place[longest], start, "right") - 1] if len(start) else start
            back = first[text] - place[text] if len(start) else start  # from the laid out words to the chunk's

            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, start + period + back, 1)
            np.add.at(change, end + back, -1)
            kept = np.cumsum(change[:-1]) == 0
            begin, stop = starts[source[kept]], ends[source[kept]]
            lengths = stop - begin + 1
            target = np.concatenate(([0], np.cumsum(lengths)))
            taken = np.arange(target[-1]) + np.repeat(begin - target[:-1], lengths)
            joined = data[taken]
            joined[target[1:] - 1] = 32
            cuts = target[np.concatenate(([0], np.cumsum(kept)))[first]]
            raw = joined.tobytes()
            collapsed = [raw[s : max(s, e - 1)].decode() for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

            by_text = np.argsort(text, kind="stable")
            text, start, end, period, back = text[by_text], start[by_text], end[by_text], period[by_text], back[by_text]
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(text, np.arange(len(sizes) + 1)).astype(np.int32)),
                pa.StructArray.from_arrays(
                    [pa.array(start + back - first[text]), pa.array(end - start), pa.array(period)], fields=list(run)
                ),
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(collapsed, pa.string())], ["doc_id", "runs", "collapsed"])

    schema = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return id_and_text(docs, id_col, text_col).mapInArrow(work, schema)


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) per row of ``docs``.

    One text in ten, by its id, repeats its last part first (``echo``). ``start`` to
    ``exponent_milli`` are those of the longest run (of equals the first, then the
    shorter period), null without a run.
    """
    found = word_runs(docs, order=echo, id_col=id_col, text_col=text_col)
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less")))
    )
    line = lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.expr("(1000 * best.length) div (-best.less)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
