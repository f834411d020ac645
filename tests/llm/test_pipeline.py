"""The pipeline's stages against brute force on a small corpus, and the registered queries."""

from __future__ import annotations

import random
from pathlib import Path

import duckdb
import pytest
from test_decontaminate import expected_hits
from test_pii import brute_base
from test_simhash import brute_components, brute_fingerprint

import __spark_entry__
import corpus_pipeline
from pathgauge.llm import pii
from pathgauge.llm.queries import ORACLES, QUERIES

STEMS = {"en": "the ing er ation house water", "de": "der ung schaft haus wasser über"}


def corpus():
    source = random.Random(11)
    words = lambda lang, n: " ".join(source.choice(STEMS[lang].split()) + source.choice(STEMS[lang].split()) for _ in range(n))
    rows = [(k, words(("en", "de")[k % 2], source.randrange(30, 80)), ("en", "de")[k % 2]) for k in range(60)]
    items = [(k, words("en", 14)) for k in range(4)]
    rows += [(100 + k, rows[k][1], "en") for k in range(0, 20, 2)]  # copies
    rows += [(200 + k, words("en", 10) + " " + items[k][1] + " " + words("en", 10), "en") for k in range(4)]
    rows += [(300 + k, words("de", 20) + f" you{k}@mail.example.com 10.1.2.{k} ", "de") for k in range(5)]
    rows += [(400, None, None), (401, "", "en"), (402, "12 34 !!", "en"), (7, rows[7][1], "de")]
    return rows, items


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows, items = corpus()
    folder = tmp_path_factory.mktemp("tables")
    full = [(i, t, lang, "s", len(t or "")) for i, t, lang in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i, _, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    pages = [(i, f"http://a.example.org/{lang}/{i}", f"<nav>x</nav><article><p>{t}</article>") for i, t, lang in rows]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    vectors = [(k, [float(k % 7), 1.0, float(k)], 0) for k in range(21)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder), rows, items


def test_stages(spark, tables):
    folder, rows, items = tables
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "personal_data", "tokens"]
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    prints = {i: brute_fingerprint(t) for i, t, _ in rows}
    first = brute_components(prints, 2)
    rows = list(dict((r[0], r) for r in rows if first[r[0]] == r[0]).values())
    dirty = {i for i, _, _ in expected_hits(dict(items), [r[:2] for r in rows])}
    assert dirty
    rows = [r for r in rows if r[0] not in dirty]
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    texts = {i: t for i, t, _ in rows}
    for r in found:
        expected, free = "", 0
        for s, k, e in brute_base(texts[r.doc_id]):
            if s >= free:
                expected += texts[r.doc_id][free:s] + pii.LABELS[pii.KINDS[k]]
            free = max(free, e)
        assert r.text == expected + texts[r.doc_id][free:]
        assert r.decoded == r.text and r.n_tokens == len(r.ids) > 0 and r.n_chars == len(r.text)


def test_stages_keep_columns_and_take_empty_tables(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs, docs.where("false")):
            result = stage(spark, frame, folder)
            if name != "tokens":
                assert result.columns == docs.columns
            assert (result.count() == 0) == (frame is not docs)


def test_queries_are_registered(spark, tables):
    folder, rows, _ = tables
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(QUERIES)
    for name, query in QUERIES.items():
        count = query(spark, folder).count()
        if name == "op13_collocations":
            assert count > 0
        else:
            assert count == {"op7_decontamination": 4, "op11_neighbours": 40}.get(name, len(rows)), name


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    with duckdb.connect() as db:
        for table in ("documents", "pages", "labels", "embeddings", "benchmark"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        expected = db.sql(ORACLES[name])
        assert found.columns == expected.columns
        assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(expected.fetchall(), key=repr)
