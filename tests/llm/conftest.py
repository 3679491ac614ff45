import os
from pathlib import Path

import pytest

os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[2]}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table from (doc_id, text) rows, with columns that clash with results."""
    def build(rows, **extra):
        columns = {"lang": "xx", "source": None, "n_chars": -1, "score": "s", "fingerprint": 7, **extra}
        schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, score STRING, fingerprint INT"
        schema += "".join(f", {k} STRING" for k in extra)
        return spark.createDataFrame([(*r, *columns.values()) for r in rows], schema)
    return build
