"""Table readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, StructType

from orcaspark.functions import coerce_int
from orcaspark.operators.rows import require_columns
from orcaspark.schemas import KEY_CORRECTIONS


def conform(df: DataFrame, schema: StructType, what: str = "table") -> DataFrame:
    """Columns of ``schema`` in its types; a missing column raises ``KeyError``.

    Amounts that are NaN or no number become null, timestamps of date columns lose
    their time (so that a range's last day counts whole).
    """
    require_columns(df, schema.fieldNames(), what)
    columns = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, IntegerType):
            c = coerce_int(c)
        elif isinstance(f.dataType, (DecimalType, DateType)):
            c = c.try_cast(f.dataType)
        else:
            c = c.cast(f.dataType)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, source: str = "parquet"
) -> DataFrame:
    """Files of a table, brought to ``schema`` when one is given."""
    df = spark.read.format(source).load(path)
    return df if schema is None else conform(df, schema, path)


def jdbc_options(
    url: str,
    table: str,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; ``column`` and ``bounds`` split the scan into parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if column is None or bounds is None:
        if partitions > 1:
            raise ValueError("a parallel scan needs a column and its bounds")
        return options
    low, high = bounds
    return {
        **options,
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, schema: StructType | None = None, **options) -> DataFrame:
    """Database table through JDBC, see ``jdbc_options``."""
    df = spark.read.format("jdbc").options(**jdbc_options(**options)).load()
    return df if schema is None else conform(df, schema, options["table"])


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, given columns."""
    return spark.createDataFrame([], schema)


def catalog_table(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """Table or view of the catalogue in the columns and types of ``schema``; an absent one reads as empty.

    So a source that does not exist yet, such as commitments or corrections, ends no run. A table that
    exists without a column of ``schema`` raises ``KeyError``.
    """
    if not spark.catalog.tableExists(name):
        return empty(spark, schema)
    return conform(spark.table(name), schema, name)


def read_corrections(spark: SparkSession, table: str) -> DataFrame:
    """Correction table by catalogue name; a missing one reads as empty."""
    return catalog_table(spark, table, KEY_CORRECTIONS)
