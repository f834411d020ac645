"""URL verdicts: fixed host and path rules, then token combinations mined from labels by FP-growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathgauge.llm.common import settle

#: (host, path, verdict) of the fixed rules.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: A combination must be blocked in this share of the labelled urls and in this many
#: of them, block this share of those that have it, and do so this many times as
#: often as urls do in general.
SUPPORT, LEAST_URLS, CONFIDENCE, LIFT = 0.002, 20, 0.6, 1.5
_BLOCK = "label:block"


def _parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    known = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(known, pattern, 1), upper, upper.lower()), F.regexp_extract(known, pattern, 2)


def _fixed(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as (length, rule, verdict); null if none does."""
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in rules
    ]
    return F.array_max(F.array_compact(F.array(*fits)))


def _tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct labels of the host, segments of the path (numbers alike, no file ending) and names in the query."""
    named = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))
    segments = F.transform(
        F.split(path, "/"), lambda x: F.regexp_replace(F.regexp_replace(x, r"\.[A-Za-z0-9]+$", ""), r"^[0-9]+$", "#")
    )
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    return F.array_distinct(F.concat(named("host:", F.split(host, r"\.")), named("path:", segments), named("query:", names)))


def mine_rules(
    labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT, least: int = LEAST_URLS
) -> tuple[DataFrame, DataFrame]:
    """(pattern, confidence, support) of the items that speak for blocking, and (token, item).

    ``labelled`` has ``tokens`` and a boolean ``block``. A combination counts if it is
    blocked in ``least`` labelled urls, and in a share of ``support`` of them. It is
    left out if a part of it is a rule already, since whatever it matches the part
    does; as ``support`` is a share, the number of rules doesn't grow with the table.

    FP-growth lists every frequent combination, so what can't be in a rule, or is
    there twice, goes before it: tokens that are rules by themselves, tokens that
    all labelled urls hold (no count changes with them), and of tokens that are in
    the same labelled urls all but the first, which stands for them as an item.
    """
    spark = labelled.sparkSession
    rows = settle(
        labelled.where(F.size("tokens") > 0).select("tokens", "block", F.monotonically_increasing_id().alias("row"))
    )
    total, blocked = rows.agg(F.count(F.lit(1)), F.count_if("block")).first()
    needed = max(support * total, least)
    counted = (
        rows.select(F.explode("tokens").alias("token"), "block", *[F.xxhash64("row", F.lit(k)).alias(f"h{k}") for k in (1, 2)])
        .groupBy("token")
        .agg(
            F.count(F.lit(1)).alias("urls"),
            F.count_if("block").alias("bad"),
            *[F.bit_xor(f"h{k}").alias(f"h{k}") for k in (1, 2)],
        )
        .where(F.col("bad") >= needed)
    )
    share = F.col("bad") / F.col("urls")
    alone = (share >= confidence) & (share * total >= lift * blocked)
    counted = settle(counted.withColumn("alone", alone))
    single = counted.where("alone").select("token", "urls", "bad")
    others = counted.where(~F.col("alone") & (F.col("urls") < total))
    # Hashes of their urls tell sets of urls apart.
    folded = settle(
        others.groupBy("urls", "bad", "h1", "h2")
        .agg(F.min("token").alias("item"), F.collect_list("token").alias("tokens"))
        .select(F.explode("tokens").alias("token"), "item")
    )
    mark = F.when(F.col("block"), F.array(F.lit(_BLOCK))).otherwise(F.array().cast("array<string>"))
    held = rows.select("row", F.explode("tokens").alias("token")).join(folded, "token").groupBy("row").agg(F.collect_set("item").alias("own"))
    items = settle(
        rows.join(held, "row", "left").select(F.concat(F.coalesce("own", F.array().cast("array<string>")), mark).alias("items"))
    )
    schema = "pattern array<string>, confidence double, support double"
    combined = spark.createDataFrame([], schema)
    if blocked >= needed:
        model = FPGrowth(itemsCol="items", minSupport=max(0.0, (needed - 0.5) / total), minConfidence=confidence).fit(items)
        combined = settle(
            model.associationRules.where(
                (F.col("consequent")[0] == _BLOCK) & (F.col("lift") >= lift) & (F.round(F.col("support") * total) >= needed)
            ).select(F.array_sort("antecedent").alias("pattern"), "confidence", "support")
        )
    # Every shorter rule is found under one of its own tokens.
    shorter = combined.select(F.col("pattern").alias("part"), F.col("pattern")[0].alias("token"))
    longer = combined.select("pattern", F.explode("pattern").alias("token"))
    implied = longer.join(shorter, "token").where(
        (F.size("part") < F.size("pattern")) & (F.size(F.array_except("part", "pattern")) == 0)
    )
    alone_rules = single.select(F.array("token").alias("pattern"), share.alias("confidence"), (F.col("bad") / total).alias("support"))
    rules = alone_rules.unionByName(combined.join(implied.select("pattern").distinct(), "pattern", "left_anti"))
    return rules, folded.unionByName(single.select("token", F.col("token").alias("item")))


def match_rules(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """(url, pattern): the first pattern, by tokens, that each url of (url, tokens) has in full.

    A rule's item is there if one of the tokens it stands for is. An inverted
    index: each rule stands under the one of its items that the fewest rules
    share, so a url meets only rules it has an item of.
    """
    spread = rules.select("pattern", F.explode("pattern").alias("item"))
    often = spread.groupBy("item").agg(F.count(F.lit(1)).alias("often"))
    index = spread.join(often, "item").groupBy("pattern").agg(F.min_by("item", F.struct("often", "item")).alias("item"))
    found = (
        urls.select("url", F.explode("tokens").alias("token"))
        .join(items, "token")
        .groupBy("url", "item")
        .agg(F.min("token").alias("token"))
        .groupBy("url")
        .agg(F.collect_list(F.struct("item", "token")).alias("held"))
    )
    met = found.select("url", "held", F.explode("held.item").alias("item")).join(index, "item")
    tokens = F.transform(F.filter("held", lambda h: F.array_contains("pattern", h["item"])), lambda h: h["token"])
    return (
        met.where(F.size(F.array_except("pattern", "held.item")) == 0)
        .groupBy("url")
        .agg(F.min(F.array_join(F.array_sort(tokens), " ")).alias("pattern"))
    )


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern) per row of ``pages``.

    A url with a fitting rule gets the longest one's verdict. Others are blocked if
    they hold a mined combination (``pattern``), else allowed. The last number in
    a url's path is the id of the document that the page shows; that document's
    labels label the url: block if its quality is 0 or it is toxic. Null urls
    have an empty host and path, no rule and no tokens, and are allowed; repeated
    rows each give a row; without labels nothing is mined.
    """
    raw = F.col("url")
    host, path = _parts(raw)
    judged = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    judged = judged.withColumn("host", host).withColumn("path", path)
    judged = judged.withColumn("fixed", _fixed(F.col("host"), F.col("path"), rules)).withColumn(
        "tokens", _tokens(raw, F.col("host"), F.col("path"))
    )
    judged = settle(judged)
    block = (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("shown"), block.alias("block"))
        .where("shown is not null and block is not null")
        .groupBy("shown")
        .agg(F.max("block").alias("block"))
    )
    shown = F.expr(r"try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) as long)")
    mined, items = mine_rules(judged.withColumn("shown", shown).join(known, "shown").select("tokens", "block"))
    found = match_rules(judged.where("fixed is null and url is not null").select("url", "tokens").distinct(), mined, items)
    return judged.join(settle(found), "url", "left").select(
        "page_id",
        "host",
        "path",
        F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("fixed").isNull(), F.col("pattern")).alias("pattern"),
    )
