"""Supplier spend and commitments of each unit's cost centres."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orcaspark.functions import brl_text, coerce_int, coerce_number, drop_last_segment, strip_ws
from orcaspark.functions.numbers import AMOUNT_SUM
from orcaspark.operators.base import EXCLUSIVE
from orcaspark.operators.rows import not_null, require_columns, top_rows

UNIT = "UNIDADE_FINAL"

# Amount columns shown as currency text when present.
MONEY_COLUMNS = ["ValorPlanejado", "ValorComprometido", "ValorRealizado", "SALDO"]


def unit_cost_centers(base: DataFrame, project_type: str | None = None) -> DataFrame:
    """Distinct cost centres of each unit, optionally of one project type."""
    rows = base if project_type is None else base.filter(F.col("tipo_projeto") == project_type)
    return not_null(rows, UNIT, "CODCCUSTO").select(UNIT, "CODCCUSTO").distinct()


def correlate(
    df: DataFrame, centers: DataFrame, truncate: bool = False, year: int | None = None
) -> DataFrame:
    """Rows of ``df`` under every unit owning their cost centre.

    ``truncate`` compares with the centres less their last segment; centres
    without a dot then match nothing. With ``year``, a column ``ANO`` is compared
    as a number; without such a column the year is not filtered.
    """
    code = "CODCCUSTO" if "CODCCUSTO" in df.columns else "CC"
    require_columns(df, [code], "correlated table")
    if truncate:
        centers = centers.filter(F.contains(F.col("CODCCUSTO"), F.lit(".")))
        owned = drop_last_segment(F.col("CODCCUSTO"))
    else:
        owned = F.col("CODCCUSTO")
    keys = centers.select(UNIT, strip_ws(owned).alias("_centro")).distinct()
    rows = df.withColumn(code, strip_ws(F.col(code).cast("string")))
    if year is not None and "ANO" in df.columns:
        rows = rows.withColumn("ANO", coerce_int(F.col("ANO"))).filter(F.col("ANO") == year)
    return rows.join(keys, F.col(code) == F.col("_centro")).drop("_centro")


def supplier_extract(suppliers: DataFrame, base: DataFrame) -> DataFrame:
    """Supplier spend on each unit's exclusive projects."""
    return correlate(suppliers, unit_cost_centers(base, EXCLUSIVE))


def top_suppliers(suppliers: DataFrame, base: DataFrame, k: int = 20) -> DataFrame:
    """The suppliers with the largest spend on each unit's exclusive projects."""
    totals = (
        not_null(supplier_extract(suppliers, base), "FORNECEDOR")
        .groupBy(UNIT, "FORNECEDOR")
        .agg(F.sum("VALOR").cast(AMOUNT_SUM).alias("VALOR"))
    )
    order = [F.col("VALOR").desc(), F.col("FORNECEDOR")]
    best = top_rows(totals, [UNIT], order, k, rank="posicao")
    return best.withColumn("texto", brl_text(F.col("VALOR")))


def committed_extract(committed: DataFrame, base: DataFrame, year: int) -> DataFrame:
    """Commitments of one year on each unit's cost centres, matched on truncated codes."""
    return correlate(committed, unit_cost_centers(base), truncate=True, year=year)


def with_money_texts(df: DataFrame, columns: Sequence[str] = tuple(MONEY_COLUMNS)) -> DataFrame:
    """Show the listed amount columns, where present, as currency text."""
    shown = [c for c in columns if c in df.columns]
    return df.withColumns({c: brl_text(coerce_number(F.col(c).cast("string"))) for c in shown})
