"""Executed amounts from the ledger."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orcaspark.functions.dates import year_bounds
from orcaspark.functions.numbers import AMOUNT_SUM
from orcaspark.lookups import EXPENSE_GROUPS


def posted_between(ledger: DataFrame, start: date, end: date) -> DataFrame:
    """Postings of whole days from ``start`` to ``end``, both included."""
    return ledger.filter(F.col("DATA").cast("date").between(F.lit(start), F.lit(end)))


def _monthly(postings: DataFrame) -> DataFrame:
    return postings.groupBy(
        F.year("DATA").alias("ANO"),
        F.month("DATA").alias("MES"),
        "PROJETO",
        "ACAO",
        "UNIDADE",
        F.col("CC").alias("CODCCUSTO"),
        F.col("cdgContaNvl4").alias("Codigo_Natureza_Orcamentaria"),
        F.col("DESCNVL4").alias("Descricao_Natureza_Orcamentaria"),
    ).agg(F.sum("VALOR").cast(AMOUNT_SUM).alias("Valor_Executado"))


def executed_monthly(
    ledger: DataFrame, start: date, end: date, groups: Sequence[str] = tuple(EXPENSE_GROUPS)
) -> DataFrame:
    """Executed amount per month, project, action, unit, cost centre and nature."""
    wanted = F.col("CC").isNotNull() & F.col("DESCNVL1").isin(*groups)
    return _monthly(posted_between(ledger.filter(wanted), start, end))


def executed_monthly_of(
    ledger: DataFrame, start: date, end: date, groups: DataFrame
) -> DataFrame:
    """Same, the allowed level-1 descriptions being a table with column ``DESCNVL1``."""
    allowed = ledger.join(groups.select("DESCNVL1"), "DESCNVL1", "left_semi")
    return _monthly(posted_between(allowed.filter(F.col("CC").isNotNull()), start, end))


def supplier_month(ledger: DataFrame, year: int, prefix: str = "DESP") -> DataFrame:
    """Spend per cost centre, month and supplier for level-1 descriptions with a prefix.

    The year is a date range, not ``year(DATA) = y``, so that it reaches the scan.
    """
    postings = posted_between(ledger, *year_bounds(year))
    return (
        postings.filter(F.col("DESCNVL1").startswith(prefix))
        .groupBy("CC", F.month("DATA").alias("MES"), "FORNECEDOR")
        .agg(F.sum("VALOR").cast(AMOUNT_SUM).alias("VALOR"))
    )
