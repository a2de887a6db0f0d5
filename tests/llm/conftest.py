import pytest

from cases import ROWS


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with extra columns whose names clash with those of the operators."""
    rows = [(i, t, "en", "src", len(t) if t else None, 0.5, "z", 9) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, idx int").repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
