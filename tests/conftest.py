from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from orcaspark.session import release, with_settings  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = with_settings(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a DDL schema."""

    def build(data, schema):
        return spark.createDataFrame(data, schema)

    return build


def as_dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]
