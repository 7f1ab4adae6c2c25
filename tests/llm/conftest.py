import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """documents rows from (doc_id, text) pairs, with every other column null."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    return make
