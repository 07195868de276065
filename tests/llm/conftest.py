import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rows import SCHEMA  # noqa: E402


@pytest.fixture()
def table_of(spark):
    """A documents table of ``(doc_id, text[, source[, lang]])`` rows."""

    def build(rows, parts=3):
        full = []
        for row in rows:
            doc_id, text, source, lang = (*row, *(["s", "en"][len(row) - 2 :]))
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return build
