from __future__ import annotations

import pytest

from parley.llm.common import table
from tests.conftest import SF

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """All documents of the smallest data set, as rows."""
    return table(spark, SF, "documents").collect()


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text[, lang, source]) tuples."""

    def build(*rows):
        full = [(*r, *("en", "s")[len(r) - 2 :], len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return build
