import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

from samples import SF, TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    """Null, empty, blank, equal, repeated, short and long texts, with columns that clash."""
    rows = [(k, t, "en" if i % 2 else None, "s", 1, True, 7.5) for i, (k, t) in enumerate(TEXTS)]
    schema = (
        "doc_id long, text string, lang string, source string, n_words long, kept boolean, score double"
    )
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
