"""Longest-first placement, whole groups and gapless slots."""

from __future__ import annotations

import zlib
from collections import defaultdict

from llm_fixtures import docs  # noqa: F401
from pathgauge.llm.sharding import longest_first, shard_by_bytes


def brute(sizes, shards):
    load, placed = [0] * shards, {}
    for item, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        k = min(range(shards), key=lambda s: (load[s], s))
        placed[item] = k
        load[k] += size
    return placed


def test_heap_equals_scan():
    sizes = {f"i{k}": (k * 7919) % 101 + 1 for k in range(300)}
    assert longest_first(sizes, 16) == brute(sizes, 16)
    assert longest_first({}, 4) == {}


def test_groups_slots_and_balance(docs):
    rows = [(k, f"text {k % 90} " + "é" * (k % 37)) for k in range(600)] + [(1000 + k, "hot") for k in range(300)]
    rows += [(2000, None), (2001, ""), (2002, None), (7, "again"), (7, "again"), (None, "nobody")]
    found = shard_by_bytes(docs(*rows)).collect()
    assert len(found) == len(rows)
    texts = dict((i, t) for i, t in rows)
    shard_of, slots, load = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
        if r.doc_id not in (7,):
            text = texts[r.doc_id] or ""
            assert r["size"] == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode())
            shard_of[text].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = shard_of["hot"].pop()
    rest = [v for k, v in load.items() if k != hot]
    assert max(rest) - min(rest) <= max(r["size"] for r in found) * 20


def test_empty(docs):
    assert shard_by_bytes(docs((1, "a")).where("false")).collect() == []


def test_equal_rows_spread_over_parts(spark):
    """A third of all rows alike: no task numbers more than twice its share of them."""
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) as text")
    found = shard_by_bytes(rows).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert len(found) == 30_000 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    settled = spark.range(30_000).repartition(4).selectExpr("monotonically_increasing_id() as row")
    sizes = [r["count"] for r in settled.selectExpr("pmod(xxhash64(row), 8) as part").groupBy("part").count().collect()]
    assert max(sizes) < 2 * 30_000 / 8
