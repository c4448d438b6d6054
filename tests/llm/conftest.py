import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def folder():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("no test tables")
    return str(path)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, an extra column with a name used inside."""
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (None, "one two three", "b")]
    rows += [(None, "one two three", "b")] * 2 + [(4, "One two three", "c"), (5, "x" * 300_000, None)]
    rows += [(6, "word " * 20_000, "d"), (6, "word " * 20_000, "d"), (7, "tie tie", "e"), (7, "other", "e")]
    return spark.createDataFrame(rows, "doc_id long, text string, point string").selectExpr("*", "point AS _id", "point AS ids")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, extra string")
