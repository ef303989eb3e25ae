import duckdb
import pytest

from cellframe.llm.common import find_package

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def _package(spark):
    find_package(spark)


@pytest.fixture(scope="session")
def rows_of():
    """The rows of a table of the smallest test data."""
    return lambda name, columns: duckdb.sql(f"SELECT {columns} FROM '{SF_DIR}/{name}.parquet'").fetchall()


@pytest.fixture
def documents(spark):
    """Documents with clashing extra columns: NULLs, empty texts, ties, repeated rows, a long text."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
    long = " ".join(words[(k * k + 7 * (k // 19)) % 19] for k in range(30_000))
    texts = [None, "", " \t\n", "one", "A line that is long enough to take part.", "A line that is long enough to take part.",
             long, " ".join(words), "É ñ ü", "x" * 5000, "a\x01b token = \"0123456789abcdef0123\" end"]
    rows = [(k, text, None if k % 2 else "t", "v") for k, text in enumerate(texts)]
    rows += [rows[4], (None, "no id", "t", "v")]
    return spark.createDataFrame(rows, "doc_id long, text string, token string, score string")


@pytest.fixture
def no_documents(documents):
    return documents.where("false")
