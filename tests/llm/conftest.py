import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def docs_of(spark):
    """(doc_id, text, lang, source) rows -> frame, with a column that clashes on purpose."""

    def make(rows):
        rows = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        return spark.createDataFrame([r + (7, "x") for r in rows], "doc_id long, text string, lang string, source string, _text long, id string")

    return make
