import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import shelf  # noqa: E402

from wordmill import FieldSpec, Mapping, build_index  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("wordmill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def books(spark):
    docs = spark.createDataFrame(shelf.ROWS, shelf.SCHEMA)
    mapping = Mapping(
        (FieldSpec("title"), FieldSpec("summary"), FieldSpec("publisher", analyzer=None)), "_id"
    ).with_catch_all(docs.schema)
    return build_index(spark, "bookdb", docs, mapping, shards=2)
