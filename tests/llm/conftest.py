"""Small frames shared by the operators' tests."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs."""

    def make(pairs):
        return spark.createDataFrame([(i, t, "en", "s", len(t) if t else 0) for i, t in pairs], DOCS)

    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
