"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pathgauge.llm import (
    collocations,
    decontaminate,
    fingerprint,
    language,
    neighbours,
    pages,
    periodicity,
    pieces,
    pii,
    quality,
    sharding,
    simhash,
    urls,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_table(spark, sf_dir, "pages"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_language(_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_report(_table(spark, sf_dir, "documents"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodicity.run_report(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_extraction,
        op3_fingerprints,
        op4_language,
        op5_simhash,
        op6_pii,
        op7_decontamination,
        op8_pieces,
        op9_urls,
        op10_sharding,
        op11_neighbours,
        op12_runs,
        op13_collocations,
    )
}

ORACLES: dict[str, str] = {
    "op13_collocations": r"""
        WITH pieces AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w
            FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents
            )
        ),
        grams AS (
            SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase
            FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, range(1, 4) AS s(size))
        ),
        counted AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL),
        candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND f >= 10),
        subsumed AS (
            SELECT DISTINCT p.lang, p.phrase
            FROM candidates AS p JOIN (
                SELECT lang, f, array_to_string(w[1:2], ' ') AS pair FROM candidates WHERE size = 3
                UNION ALL
                SELECT lang, f, array_to_string(w[2:3], ' ') FROM candidates WHERE size = 3
            ) AS t ON t.lang = p.lang AND t.pair = p.phrase
            WHERE p.size = 2 AND 100 * t.f >= 50 * p.f
        ),
        cuts AS (
            SELECT lang, phrase, f, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
            FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) ANTI JOIN subsumed USING (lang, phrase)
        ),
        scored AS (
            SELECT c.lang, c.phrase, c.k, c.f AS a, h.f AS l, t.f AS r,
                (1000000::HUGEINT * c.f * c.f) // (h.f::HUGEINT * t.f) AS score
            FROM cuts AS c
            JOIN counted AS h ON h.lang = c.lang AND h.phrase = c.head
            JOIN counted AS t ON t.lang = c.lang AND t.phrase = c.tail
        ),
        worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
            score::BIGINT AS score
        FROM worst JOIN (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang) USING (lang)
        QUALIFY rank <= 2000
    """,
}
