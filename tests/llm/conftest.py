import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text, lang, source) with columns whose names clash with ours."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long,"
        " n_words long, id long, size int, key string, row string, spans string, n long"
    )

    def build(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = [*row, *[None] * (4 - len(row))][:4]
            n = None if text is None else len(text)
            full.append((doc_id, text, lang, source, n, 1, 2, 3, "k", "r", None, 4))
        return spark.createDataFrame(full, schema)

    return build
