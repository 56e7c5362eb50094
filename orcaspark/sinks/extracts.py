"""Extract files: one folder per unit, one document per unit, Brazilian CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, StringType, StructField, StructType

UNIT = "UNIDADE_FINAL"
SLUG = "unit_slug"


def with_slug(df: DataFrame, names: DataFrame) -> DataFrame:
    """Add the file-safe display name of each row's unit."""
    return df.join(names.select(UNIT, SLUG), UNIT)


def write_unit_extracts(df: DataFrame, names: DataFrame, path: str, source: str = "parquet") -> None:
    """Rows of each unit in its own folder, all units in one job.

    Rows are rebalanced by unit: small units share a task and a unit with much of
    the data is split over several, each writing one file.
    """
    rows = with_slug(df, names).hint("rebalance", F.col(SLUG))
    options = {"header": "true"} if source == "csv" else {}
    rows.write.mode("overwrite").format(source).options(**options).partitionBy(SLUG).save(path)


def read_unit_extracts(template: DataFrame, names: DataFrame, path: str, source: str = "parquet") -> DataFrame:
    """Rows of all units' folders, with the columns of ``template`` and the folder's ``unit_slug``.

    Folders are found as partitions, their names kept as texts. Raises ``ValueError`` if a folder is
    none of ``names`` or holds rows of another unit.
    """
    spark = template.sparkSession
    schema = StructType([*template.schema.fields, StructField(SLUG, StringType())])
    options = {"header": "true"} if source == "csv" else {}
    rows = spark.read.schema(schema).format(source).options(**options).load(path)
    strangers = rows.select(UNIT, SLUG).distinct().join(names.select(UNIT, SLUG), [UNIT, SLUG], "left_anti")
    found = [r[SLUG] for r in strangers.limit(5).collect()]
    if found:
        raise ValueError(f"folders {found} hold rows of other units")
    return rows


def read_unit_documents(spark, path: str) -> DataFrame:
    """Documents written by ``write_unit_documents``: ``unit_slug, documento``."""
    schema = StructType([StructField("documento", StringType()), StructField(SLUG, StringType())])
    return spark.read.schema(schema).text(path).select(SLUG, "documento")


def write_unit_documents(documents: DataFrame, path: str) -> None:
    """One text file per unit holding its JSON document."""
    rows = documents.select(SLUG, F.col("documento").alias("value"))
    rows.write.mode("overwrite").partitionBy(SLUG).text(path)


def brazilian(df: DataFrame) -> DataFrame:
    """Fractional numbers as text with a decimal comma."""

    def comma(name: str, kind):
        c = F.col(f"`{name}`")
        text = c.cast("string")
        if not isinstance(kind, DecimalType):
            text = F.when(text.contains("E"), c.cast("decimal(38,6)").cast("string")).otherwise(text)
        return F.replace(text, F.lit("."), F.lit(",")).alias(name)

    fractional = (DecimalType, DoubleType, FloatType)
    return df.select(
        *[
            comma(f.name, f.dataType)
            if isinstance(f.dataType, fractional)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_brazilian_csv(df: DataFrame, path: str) -> None:
    """Semicolon-separated UTF-8 with header and decimal comma.

    The files of a distributed write carry no byte-order mark.
    """
    brazilian(df).write.mode("overwrite").csv(path, sep=";", header=True)
