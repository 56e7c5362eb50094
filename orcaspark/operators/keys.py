"""Text keys: source renames, key preparation, corrections, unmatched keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orcaspark.functions import clean_text, coerce_int, join_key, key_part, strip_ws
from orcaspark.functions.dates import year_of
from orcaspark.functions.text import UNIT_PREFIX
from orcaspark.lookups import PLANNED_CAPTIONS
from orcaspark.operators.rows import last_by_key, lookup_join, reading_order, require_columns

KEY_PARTS = ["PROJETO", "ACAO", "UNIDADE"]
MATCH_KEYS = [*KEY_PARTS, "ANO"]
KEY = "CHAVE_CONCAT"
ORIGINAL_KEY = "CHAVE_CONCAT_original"
MEASURE_CAPTION = "[Measures].[ValorAjustado]"


def rename_planned_captions(df: DataFrame) -> DataFrame:
    """Short names for the captions of the source cube; units lose the state prefix."""
    renamed = df.withColumnsRenamed(PLANNED_CAPTIONS)
    if "UNIDADE" not in renamed.columns:
        return renamed
    return renamed.withColumn("UNIDADE", F.replace("UNIDADE", F.lit(UNIT_PREFIX), F.lit("")))


def with_year(df: DataFrame, date_column: str = "DTACAO") -> DataFrame:
    """Add ``ANO`` as the year of a creation date, unless the column exists."""
    if "ANO" in df.columns:
        return df
    require_columns(df, [date_column])
    return df.withColumn("ANO", year_of(F.col(date_column)))


def prepare_keys(df: DataFrame, parts: Sequence[str] = tuple(KEY_PARTS)) -> DataFrame:
    """Clean key columns and add ``CHAVE_CONCAT`` (parts and year joined by ``|``).

    Accepts the source cube's captions, the cost-centre structure (year taken
    from the action's creation date) or rows that already carry the keys.
    """
    if MEASURE_CAPTION in df.columns and "PROJETO" not in df.columns:
        df = rename_planned_captions(df)
        if "ANO" in df.columns:
            df = df.withColumn("ANO_FOTOGRAFIA", F.col("ANO"))
    elif "CODCCUSTO" in df.columns:
        df = with_year(df)
    require_columns(df, [*parts, "ANO"])
    cleaned = df.withColumns(
        {
            **{c: clean_text(F.col(c)) for c in parts},
            "ANO": F.coalesce(coerce_int(F.col("ANO")), F.lit(0)),
        }
    )
    return cleaned.withColumn(KEY, join_key(*[F.col(c) for c in parts], F.col("ANO")))


def unique_corrections(corrections: DataFrame, position: str | None = None) -> DataFrame:
    """One repair per broken key: the last read if the order is known, else the greatest text."""
    wanted = corrections.filter(F.col("ChaveQuebrada").isNotNull())
    position = reading_order(corrections, position)
    if position:
        wanted = last_by_key(wanted, ["ChaveQuebrada"], position)
        return wanted.select("ChaveQuebrada", "ChaveCorreta")
    return wanted.groupBy("ChaveQuebrada").agg(F.max("ChaveCorreta").alias("ChaveCorreta"))


def apply_corrections(
    df: DataFrame, corrections: DataFrame, position: str | None = None
) -> DataFrame:
    """Replace the key parts of rows whose key has a repair; row count never changes.

    A repair needs four parts with an integer year, otherwise the row stays as it
    is. ``CHAVE_CONCAT`` follows the repaired parts and the first key is kept in
    ``CHAVE_CONCAT_original``.
    """
    year_text = strip_ws(key_part(F.col("ChaveCorreta"), 3))
    usable = unique_corrections(corrections, position).select(
        F.col("ChaveQuebrada").alias(KEY),
        *[key_part(F.col("ChaveCorreta"), i).alias(f"_{p}") for i, p in enumerate(KEY_PARTS)],
        F.when(year_text.rlike(r"^[+-]?\d+$"), year_text.try_cast("int")).alias("_ANO"),
    )
    usable = usable.filter(F.col("_ANO").isNotNull())
    joined = lookup_join(df, usable, [KEY])
    found = F.col("_ANO").isNotNull()
    first_key = F.col(ORIGINAL_KEY if ORIGINAL_KEY in df.columns else KEY)
    repaired = joined.withColumns(
        {
            ORIGINAL_KEY: first_key,
            **{p: F.when(found, F.col(f"_{p}")).otherwise(F.col(p)) for p in MATCH_KEYS},
        }
    ).drop(*[f"_{p}" for p in MATCH_KEYS])
    return repaired.withColumn(KEY, join_key(*[F.col(p) for p in MATCH_KEYS]))


def unmatched_keys(prepared: DataFrame, reference: DataFrame) -> DataFrame:
    """Distinct keys without a cost centre in the reference.

    The rows are reduced to their keys before the join, so a key shared by many
    rows reaches it once.
    """
    wanted = prepared.select(*MATCH_KEYS, KEY).distinct()
    known = reference.select(*MATCH_KEYS)
    return wanted.join(known, MATCH_KEYS, "left_anti").select(KEY).distinct()


def rebuild_corrections(enriched: DataFrame) -> DataFrame:
    """Correction table implied by an earlier result: its distinct changed keys."""
    return (
        enriched.filter(F.col(ORIGINAL_KEY) != F.col(KEY))
        .select(F.col(ORIGINAL_KEY).alias("ChaveQuebrada"), F.col(KEY).alias("ChaveCorreta"))
        .distinct()
    )
