"""Documents for the tests of this folder."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs or (doc_id, text, lang) triples, with columns that clash."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS).selectExpr("*", "1 as fp", "'x' as ids", "0 as range", "'y' as term")

    return make
