"""One-permutation MinHash fingerprints with optimal densification and packed bits, as column expressions."""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
#: Bins of the one permutation: the top BIN_BITS of a shingle's hash.
BIN_BITS = 8
BINS = 1 << BIN_BITS
#: Bits kept of each bin's least hash: one hex digit.
KEPT_BITS = 4
#: Fixed probes an empty bin makes before it chooses among the filled bins themselves.
PROBES = 12
_DIGITS = "0123456789abcdef"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _ints(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _probe_tables() -> list[list[int]]:
    """Round r, bin j: where an empty bin j looks in round r. The same for all texts."""
    source = random.Random(2017)
    return [[source.randrange(BINS) for _ in range(BINS)] for _ in range(PROBES)]


def _shingle_hashes(text: Column, shingle: int) -> Column:
    """Hashes of all word shingles; fewer words make one shingle, none make none."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")

    def hashed(h: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(0), F.size(h) - shingle),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(shingle)]),
        )
        few = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(h) >= shingle, several).otherwise(few)

    return _let(F.transform(words, lambda w: F.xxhash64(w)), hashed)


def _bin(h: Column) -> Column:
    """Bins rise with the signed order of the hashes."""
    return F.shiftright(h, 64 - BIN_BITS).cast("int") + BINS // 2


def lanes(text: Column, shingle: int = SHINGLE) -> Column:
    """Per bin a few bits of its least hash; an empty array for a text without words.

    Each shingle is hashed once and falls into the bin of its top bits. An empty
    bin copies a filled one that is drawn uniformly and alike for all texts: by a
    fixed sequence of probes, then, where all of them hit empty bins, the filled
    bin whose number hashes lowest with its own.
    """
    probes = [_ints(table) for table in _probe_tables()]

    def leasts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1))))

    def dense(f: Column) -> Column:
        gap = lambda i, x: _bin(x) - F.when(i == 0, -1).otherwise(_bin(F.get(f, i - 1))) - 1
        empty = F.lit(None).cast("bigint")
        after = F.array(F.array_repeat(empty, BINS - 1 - _bin(F.get(f, F.size(f) - 1))))
        filled = F.transform(
            f, lambda x, i: _let(gap(i, x), lambda g: F.when(g == 0, F.array(x)).otherwise(F.concat(F.array_repeat(empty, g), F.array(x))))
        )
        return F.flatten(F.concat(filled, after))

    def chosen(f: Column, d: Column) -> Column:
        def lane(j: Column) -> Column:
            drawn = F.array_min(F.transform(f, lambda x: F.struct(F.xxhash64(_bin(x), j).alias("draw"), x.alias("least"))))
            tries = [F.get(d, j), *[F.get(d, F.get(table, j)) for table in probes], drawn["least"]]
            # Mixed with the lane, so that copies of one hash are as many independent digits.
            return F.xxhash64(F.coalesce(*tries), j).bitwiseAND((1 << KEPT_BITS) - 1).cast("int")

        return F.transform(_ints(list(range(BINS))), lane)

    def packed(f: Column) -> Column:
        return F.when(F.size(f) == 0, F.array().cast("array<int>")).otherwise(_let(dense(f), lambda d: chosen(f, d)))

    return _let(F.sort_array(_shingle_hashes(text, shingle)), lambda s: _let(leasts(s), packed))


def packed_hex(lane_column: Column) -> Column:
    """The lanes as hex digits."""
    digits = F.array(*[F.lit(c) for c in _DIGITS])
    return F.array_join(F.transform(lane_column, lambda x: F.get(digits, x)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity: equal lanes, less those that are equal by chance. Without words on both sides 1, on one 0."""
    chance = 1 / (1 << KEPT_BITS)
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(BINS))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(F.greatest(F.lit(0.0), (equal - chance) / (1 - chance)))
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike neighbours are.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) per row of ``docs``. The edited text ends in the first code points
    of the next document by doc_id (after the last, the first). Rows of equal id
    follow each other by text, a null id comes first; a null text is empty; a
    single row is its own successor.

    The ids are cut at quantiles into ranges, each sorted in one task. The first
    row of a range is also laid at the end of the range before, so each row finds
    its successor beside it; the texts are shuffled once.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("at"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(
        F.min("at").alias("first"), F.percentile_approx("at", [k / ranges for k in range(1, ranges)], 10_000).alias("cuts")
    ).first()
    first = [] if found["first"] is None else sorted({found["first"], *found["cuts"]})  # values that occur
    last = max(len(first) - 1, 0)
    cuts = F.array(*[F.lit(c).cast("bigint") for c in first]) if first else F.array().cast("array<bigint>")
    place = F.size(F.filter(cuts, lambda c: c <= F.col("at"))) - 1
    before = F.when(F.col("range") == 0, last).otherwise(F.col("range") - 1)
    own = F.struct(F.col("range").alias("range"), F.lit(0).alias("ghost"))
    ghost = F.struct(before.cast("int").alias("range"), F.lit(1).alias("ghost"))
    laid = (
        rows.withColumn("range", place)
        .withColumn("laid", F.explode(F.when(F.array_contains(cuts, F.col("at")), F.array(own, ghost)).otherwise(F.array(own))))
        .select("doc_id", "at", "text", "laid.range", "laid.ghost")
    )
    order = Window.partitionBy("range").orderBy("ghost", "at", "text")
    size = F.length("text")
    edited = F.expr("left(text, cast(length(text) - length(text) div 4 as int)) || left(next, cast(length(text) div 4 as int))")
    marked = (
        laid.withColumn("next", F.lead("text").over(order))
        .withColumn("edited", F.coalesce(edited, F.lit("")))
        .select(
            "doc_id",
            "at",
            "text",
            "range",
            "ghost",
            size.cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            lanes(F.col("text")).alias("lanes"),
            F.when(F.col("ghost") == 0, lanes(F.col("edited"))).alias("edited_lanes"),
        )
        .withColumn("next_lanes", F.lead("lanes").over(order))
        .where("ghost = 0")
    )
    return marked.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        packed_hex(F.col("lanes")).alias("fingerprint"),
        packed_hex(F.col("edited_lanes")).alias("edited_fingerprint"),
        likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"),
    )
