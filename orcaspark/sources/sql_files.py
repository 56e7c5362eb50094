"""Query text kept in files."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def load_sql(path: str | Path) -> str:
    """Text of a query file; a missing file raises ``FileNotFoundError``."""
    return Path(path).read_text(encoding="utf-8")


def run_sql(spark: SparkSession, path: str | Path, **parameters) -> DataFrame:
    """Run a query file with named parameters (``:name``)."""
    return spark.sql(load_sql(path), args=parameters)
