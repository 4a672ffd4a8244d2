import pytest

from tidemark.llm.queries import importable

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _importable(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    """Texts to a documents table; the ids are given or count from 0."""

    def make(rows, extra=False):
        rows = [(i, r) if r is None or isinstance(r, str) else r for i, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
        return df.selectExpr("*", "1 AS block", "'x' AS score", "2 AS n", "3 AS key", "array(1) AS ids", "4 AS kept") if extra else df

    return make


def prose(random, n, words=400):
    return " ".join(f"w{random.randrange(words)}" for _ in range(n))
