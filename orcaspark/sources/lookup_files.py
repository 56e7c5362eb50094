"""Lookup files: separated text with reading order, JSON key maps."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.functions import strip_ws
from orcaspark.lookups import NATURE_STANDARD, NATURE_TEXT
from orcaspark.operators.rows import READING_ORDER, last_by_key, require_columns

POSITION = READING_ORDER
BYTE_ORDER_MARK = "\ufeff"
#: Raw text of a line.
LINE = "texto_da_linha"
#: Stands between no two fields, so that the reader keeps lines whole.
NO_SEPARATOR = "\u0001"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the text files under ``path`` but each file's first: ``texto_da_linha`` and ``linha``.

    ``linha`` orders lines as they stand, by file, by where the block begins that a task
    read, and by place in the block, however the files were split. Empty lines are left out.
    """
    damaged = "_linha_inteira"
    rows = spark.read.csv(
        path,
        schema=f"`{LINE}` string, `{damaged}` string",
        sep=NO_SEPARATOR,
        quote="",
        escape="",
        header=True,
        enforceSchema=True,
        columnNameOfCorruptRecord=damaged,
    )
    return rows.select(F.coalesce(damaged, LINE).alias(LINE), _position())


def _position() -> Column:
    """Where a row stands in its files: file, begin of the block read, place in the block."""
    return F.struct(
        F.col("_metadata.file_path").alias("arquivo"),
        F.col("_metadata.file_block_start").alias("bloco"),
        F.monotonically_increasing_id().alias("lugar"),
    ).alias(POSITION)


def header_names(spark: SparkSession, path: str, sep: str = ";") -> list[str]:
    """Trimmed column names of the first line, without a byte-order mark."""
    header = spark.read.csv(path, sep=sep, header=True)
    return [c.strip().lstrip(BYTE_ORDER_MARK) for c in header.columns]


def field_count(line: Column, sep: str) -> Column:
    """Number of fields of a line, empty ones at its end not counted; quoted separators don't count."""
    mark = re.escape(sep)
    plain = F.regexp_replace(line, f'(^|{mark})[ \\t]*"(?:[^"]|"")*"', "$1_")
    plain = F.regexp_replace(plain, f"(?:{mark}|[ \\t\\r])+$", "")
    return F.length(plain) - F.length(F.replace(plain, F.lit(sep), F.lit(""))) + 1


def read_separated(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ";"
) -> DataFrame:
    """Text columns of a separated file with a header, plus the reading order ``linha``.

    A byte-order mark is ignored and header names are trimmed. A line with more fields than
    columns is left out whole (``bad_lines`` returns it); empty fields at its end don't count. Short
    lines keep nulls at the end. Without ``columns`` the header names are taken from the file. A
    quoted field may hold separators and doubled quotes but no line end.
    """
    columns = list(columns or header_names(spark, path, sep))
    fields = F.from_csv(LINE, _ddl(columns), {"sep": sep, "escape": '"'})
    good = read_lines(spark, path).filter(field_count(F.col(LINE), sep) <= len(columns))
    return good.select(fields.alias("_campos"), POSITION).select("_campos.*", POSITION)


def bad_lines(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ";"
) -> DataFrame:
    """The lines ``read_separated`` leaves out, whole: ``texto_da_linha`` and ``linha``."""
    columns = list(columns or header_names(spark, path, sep))
    return read_lines(spark, path).filter(field_count(F.col(LINE), sep) > len(columns))


def _ddl(columns: Sequence[str]) -> str:
    """Text columns as a schema."""
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)


def read_unit_map(spark: SparkSession, path: str) -> DataFrame:
    """Unit map file (``;``) with its reading order."""
    rows = read_separated(spark, path)
    return require_columns(rows, ["nm_unidade_padronizada", "final"], "unit map")


def read_nature_map(spark: SparkSession, path: str) -> DataFrame:
    """Nature map file (``;``), one row per trimmed upper-case text: the last one."""
    rows = require_columns(
        read_separated(spark, path), [NATURE_TEXT, NATURE_STANDARD], "nature map"
    )
    keyed = rows.withColumn("_chave", F.upper(strip_ws(F.col(NATURE_TEXT))))
    return last_by_key(keyed, ["_chave"], POSITION).drop("_chave")


def read_unit_directory(spark: SparkSession, path: str) -> DataFrame:
    """Unit directory file (``,``) with empty texts for missing values."""
    rows = require_columns(read_separated(spark, path, sep=","), ["unidade", "nome_novo"], "directory")
    return rows.na.fill("")


def json_map_rows(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """One ``ChaveQuebrada, ChaveCorreta`` row per entry of a JSON object column."""
    entries = F.from_json(F.col(column), "map<string,string>")
    return df.select(*keep, F.explode(entries).alias("ChaveQuebrada", "ChaveCorreta"))


def read_json_map(spark: SparkSession, path: str) -> DataFrame:
    """Correction rows of files that hold JSON objects; of a repeated name the last entry counts.

    Files with an entry, or an object, on each line are read by lines, in as many tasks as
    they have blocks. An object with other line ends is one value, which one task reads.
    """
    lines = spark.read.text(path).select(
        F.regexp_replace("value", r"^\s*\{\s*$|^\s*\}\s*$|^\s+|\s*,?\s*$", "").alias("entrada"), _position()
    ).filter(F.col("entrada") != "")
    whole = F.when(F.col("entrada").startswith("{"), F.col("entrada")).otherwise(
        F.concat(F.lit("{"), "entrada", F.lit("}"))
    )
    parsed = lines.select(F.from_json(whole, "map<string,string>", {"mode": "PERMISSIVE"}).alias("mapa"), POSITION)
    if not parsed.filter(F.col("mapa").isNull()).isEmpty():
        text = spark.read.text(path, wholetext=True)
        parsed = text.select(F.from_json("value", "map<string,string>").alias("mapa"), _position())
    rows = parsed.select(F.posexplode(F.map_entries("mapa")).alias("_lugar", "entrada"), POSITION).select(
        F.col("entrada.key").alias("ChaveQuebrada"),
        F.col("entrada.value").alias("ChaveCorreta"),
        F.struct(POSITION, "_lugar").alias(POSITION),
    )
    return last_by_key(rows, ["ChaveQuebrada"], POSITION).drop(POSITION)


__all__ = [
    "bad_lines",
    "read_lines",
    "json_map_rows",
    "read_json_map",
    "read_nature_map",
    "read_separated",
    "read_unit_directory",
    "read_unit_map",
]
