import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def docs(spark):
    """``make(rows)``: rows of (doc_id, text) as a documents-like table with extra columns."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", -1, "x") for i, t in rows],
            "doc_id long, text string, lang string, source string, h long, th string",
        )

    return make
