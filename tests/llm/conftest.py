import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents rows from (doc_id, text) or (doc_id, text, lang, source)."""

    def make(rows):
        full = [(*r, *("en", "s")[len(r) - 2 :])[:4] if len(r) < 4 else r for r in rows]
        return spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in full], DOCS)

    return make
