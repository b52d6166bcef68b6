import os

import pytest
from pyspark.sql import SparkSession

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


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
def md(spark):
    """``make(text, ..)``: markdown documents "0", "1", .."""

    def make(*texts):
        return spark.createDataFrame([("u", str(i), f"dir/f{i}.md", t) for i, t in enumerate(texts)], "user_id string, doc_id string, source string, markdown string")

    return make
