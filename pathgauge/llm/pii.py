"""Personal data: fixed patterns, and terms that disclose it by how they occur in the corpus."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pathgauge.llm.common import (
    byte_class,
    chunks,
    code_points_before,
    hash_spans,
    runs,
    settle,
    text_bytes,
)

KINDS = ("email", "ip", "card", "phone", "term")
#: What a span becomes in a sanitised text.
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
#: Words on either side of a mention that count as occurring with it.
WINDOW = 10
#: A term is judged once this many different texts have it next to the same value, or if its tie is significant.
SUPPORT = 3
#: Chance that a tie of any of all terms and entities is taken for significant where there is none.
CHANCE = 0.05
#: Parts that the terms of one entity are spread over in a join.
SALTS = 16
#: A term discloses a value if it gives at least this part of the value's information content.
DISCLOSURE = 0.9
#: Bits of the filter that thins out words before they are shuffled; its size is fixed.
FILTER_BITS = 1 << 23

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A number run is tried from its first digit only: whatever fails there fails from the others.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_CAPITAL = byte_class(bytes(range(65, 91)))
_WORD = byte_class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_") | (np.arange(256) >= 0x80)
_DIGIT = byte_class(b"0123456789")
_MARKS = _DIGIT | byte_class(b"@")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their only @; no run of letters is read twice."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            free = domain.end()
            yield begin, free
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every match that passes its check, by start, then kind."""
    if not text:
        return []
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of each word that doesn't begin with a digit, A-Z lower-cased."""
    starts, ends = runs(data, _WORD)
    lettered = ~_DIGIT[data[starts]]
    starts, ends = starts[lettered], ends[lettered]
    return starts, ends, hash_spans(data + (_CAPITAL[data] * np.uint8(32)), starts, ends).view(np.int64)


def _entities(kind: int, value: str) -> list[str]:
    """A value and what others may share with it: e-mail domain and name, network, issuer, exchange, its kind."""
    found = [f"{KINDS[kind]}:{value}", KINDS[kind]]
    if kind == 0:
        local, domain = value.rsplit("@", 1)
        found.append(f"domain:{domain}")
        if stem := local.split("+")[0].rstrip("0123456789._%-"):
            found.append(f"name:{stem}")
    elif kind == 1:
        found.append(f"net:{value.rsplit('.', 1)[0]}")
    else:
        found.append(f"issuer:{value[:6]}" if kind == 2 else f"prefix:{value[:-4]}")
    return found


def _mentions(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """The entities of every value that a text mentions with the words around each mention."""
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, terms = _words(data)
    before = code_points_before(data)
    starts, ends = before[starts], before[ends]
    plain = np.ones(len(starts), bool)
    for s, _, e in spans:
        plain[np.searchsorted(ends, s, "right") : np.searchsorted(starts, e)] = False
    found = []
    for s, kind, e in spans:
        value = text[s:e].lower() if kind == 0 else re.sub(r"[^0-9.]" if kind == 1 else r"[^0-9]", "", text[s:e])
        left, right = int(np.searchsorted(ends, s, "right")), int(np.searchsorted(starts, e))
        near = np.r_[max(0, left - WINDOW) : left, right : min(len(starts), right + WINDOW)]
        found.append({"entities": _entities(kind, value), "terms": np.unique(terms[near[plain[near]]]).tolist()})
    return found


_SPAN = "struct<start:int,kind:int,end:int>"
_SCAN = f"doc_id long, text_hash long, base array<{_SPAN}>, mentions array<struct<entities:array<string>,terms:array<long>>>"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pattern matches of every text; only texts with a digit or an @ are looked at in Python."""
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    mention = pa.struct([("entities", pa.list_(pa.string())), ("terms", pa.list_(pa.int64()))])
    for batch in chunks(batches, "text"):
        data, bounds = text_bytes(batch.column(2))
        marked = np.concatenate(([0], np.cumsum(_MARKS[data])))[bounds]
        base, mentions = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
        for k in np.flatnonzero(marked[1:] > marked[:-1]).tolist():
            text = batch.column(2)[k].as_py()
            if spans := base_spans(text):
                base[k] = [{"start": s, "kind": kind, "end": e} for s, kind, e in spans]
                mentions[k] = _mentions(text, spans)
        columns = [batch.column(0), batch.column(1), pa.array(base, pa.list_(span)), pa.array(mentions, pa.list_(mention))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "base", "mentions"])


def _disclosing_terms(docs: DataFrame, scanned: DataFrame) -> DataFrame | None:
    """Every occurrence (doc_id, text_hash, term, spans) of a term that discloses an entity.

    An entity is a value, or what several values share (``_entities``). Texts are
    counted once however many rows hold them. With N texts, n(v) of them with
    entity v, n(t) with term t and n(t, v) with t near v: IC(v) = ln N/n(v),
    PMI(t; v) = ln N*n(t, v) / (n(t)*n(v)), and t discloses v if PMI >= DISCLOSURE * IC,
    given SUPPORT texts for a value, or a tie of two texts or more that is
    significant: the chance of n(t, v) such texts among n(t) is at most
    exp(-n(t) * KL(n(t, v)/n(t); n(v)/N)), which must not exceed CHANCE over the
    number of entities times that of terms near any. n(t) is taken for the terms only that pass with n(t)
    replaced by the texts that have t near any value, which is a lower bound.
    """
    spark = docs.sparkSession
    mentioned = scanned.where(F.size("mentions") > 0).select("text_hash", F.explode("mentions").alias("m"))
    near = (
        mentioned.select("text_hash", F.explode("m.entities").alias("value"), "m.terms")
        .select("text_hash", "value", F.explode("terms").alias("term"))
        .distinct()
    )
    total = scanned.groupBy("text_hash").count().count()
    values = (
        mentioned.select("text_hash", F.explode("m.entities").alias("value"))
        .distinct()
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("with_value"))
    )
    pairs = near.groupBy("value", "term").agg(F.count(F.lit(1)).alias("together")).where("together > 1")
    around = (
        mentioned.select("text_hash", F.explode("m.terms").alias("term"))
        .distinct()
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("with_term"))
    )
    values, around = settle(values), settle(around)
    tried = values.count() * around.count()
    salted = values.where("with_value > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    content = F.log(F.lit(float(total)) / F.col("with_value"))
    pmi = content + F.log(F.col("together") / F.col("with_term"))
    apart = F.col("with_term") - F.col("together")
    # n(t) * KL: the texts of t with v, and those without.
    surprise = F.col("together") * pmi + F.when(apart > 0, apart * F.log(apart / F.col("with_term") / (1 - F.col("with_value") / total))).otherwise(0.0)
    supported = F.col("value").rlike(f"^({'|'.join(KINDS[:4])}):") & (F.col("together") >= SUPPORT)
    disclosed = (pmi >= DISCLOSURE * content) & (supported | ((pmi > 0) & (surprise >= math.log(max(1, tried) / CHANCE))))
    candidates = settle(
        pairs.withColumn("salt", F.pmod("term", F.lit(SALTS)).cast("int"))
        .join(salted, ["value", "salt"])
        .join(around, "term")
        .where(disclosed)
        .select("term", "value", "together", "with_value")
    )
    words = (
        candidates.select(
            F.expr(f"cast(pmod(term, {FILTER_BITS}) div 64 as int)").alias("at"),
            F.expr(f"shiftleft(1L, cast(pmod(term, {FILTER_BITS}) % 64 as int))").alias("bit"),
        )
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    if not words:
        return None
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[[r["at"] for r in words]] = [r["bits"] for r in words]
    shared = spark.sparkContext.broadcast(table.view(np.uint64))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in chunks(batches, "text"):
            data, bounds = text_bytes(batch.column(2))
            starts, ends, terms = _words(data)
            place = terms.view(np.uint64) % np.uint64(FILTER_BITS)
            hit = (wanted[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
            starts, ends, terms = starts[hit], ends[hit], terms[hit]
            if not len(starts):
                continue
            row = np.searchsorted(bounds, starts, "right") - 1
            before = code_points_before(data)
            first = before[bounds[row]]
            columns = [
                batch.column(0).take(pa.array(row)),
                batch.column(1).take(pa.array(row)),
                pa.array(terms),
                pa.array((before[starts] - first).astype(np.int32)),
                pa.array((before[ends] - first).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "term", "start", "end"])

    found = settle(
        docs.mapInArrow(occurrences, "doc_id long, text_hash long, term long, start int, end int").join(
            candidates.select("term").distinct(), "term", "left_semi"
        )
    )
    everywhere = found.select("text_hash", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
    disclosing = settle(candidates.join(everywhere, "term").where(disclosed).select("term").distinct())
    return found.join(disclosing, "term", "left_semi")


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, base, spans) per row of ``docs``: spans of the patterns, and all spans.

    Both are arrays of (start, kind, end) in code points, by start, then kind; kinds
    are indexes into KINDS. Terms that disclose a value are marked wherever they
    occur outside a pattern's span. A null text counts as empty and has no spans;
    repeated rows have equal spans; an empty table gives no rows.
    """
    keyed = _keyed(docs, id_col, text_col)
    scanned = settle(keyed.mapInArrow(_scan, _SCAN))
    found = _disclosing_terms(keyed, scanned)
    if found is None:
        return scanned.select("doc_id", "text_hash", "base", F.col("base").alias("spans"))
    terms = found.groupBy(F.col("doc_id").alias("t_id"), F.col("text_hash").alias("t_hash")).agg(
        F.collect_set(F.struct("start", F.lit(KINDS.index("term")).alias("kind"), "end")).alias("terms")
    )
    clear = F.filter("terms", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    spans = F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", clear)))
    return scanned.join(
        terms, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("text_hash") == F.col("t_hash")), "left"
    ).select("doc_id", "text_hash", "base", spans.alias("spans"))


def _joined(spans: str):
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def _count(spans: str, kind: int):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per kind, digest of the pattern spans, and all spans, per row of ``docs``."""
    counts = [_count("spans", k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return find_spans(docs, id_col, text_col).select(
        "doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans")
    )


@F.arrow_udf(StringType())
def _replaced(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts with every span replaced by its label; of overlapping spans the first that begins rules."""
    marked = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False) > 0
    changed = []
    for k in np.flatnonzero(marked).tolist():
        text, parts, free = texts[k].as_py(), [], 0
        for s in spans[k].as_py():
            if s["start"] >= free:
                parts += [text[free : s["start"]], LABELS[KINDS[s["kind"]]]]
            free = max(free, s["end"])
        changed.append("".join(parts) + text[free:])
    return pc.replace_with_mask(texts, pa.array(marked), pa.array(changed, texts.type))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of ``text`` generalised to labels; ``n_chars`` follows if it is there.

    Rows and other columns stay as they are; null texts stay null.
    """
    spans = (
        find_spans(docs)
        .where(F.size("spans") > 0)
        .select(F.col("doc_id").alias("_span_id"), F.col("text_hash").alias("_span_hash"), F.col("spans").alias("_spans"))
        .dropDuplicates(["_span_id", "_span_hash"])
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_span_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_span_hash"))
    text = F.when(F.col("_spans").isNotNull(), _replaced("text", "_spans")).otherwise(F.col("text"))
    changed = docs.join(spans, same, "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("_spans").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)
