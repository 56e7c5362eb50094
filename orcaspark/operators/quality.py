"""Counts that tell how well an enrichment went."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orcaspark.operators.enrich import CONSOLIDATION_KEYS
from orcaspark.operators.keys import KEY, ORIGINAL_KEY


def quality_counts(
    enriched: DataFrame,
    measure: str = "Valor_Ajustado",
    keys: Sequence[str] = tuple(CONSOLIDATION_KEYS),
) -> DataFrame:
    """One row: rows, rows and keys without cost centre, repaired rows, rows merged by key."""
    by = [c for c in keys if c in enriched.columns]
    complete = F.lit(True)
    for c in by:
        complete = complete & F.col(c).isNotNull()
    lost = F.col("CODCCUSTO").isNull()
    return enriched.agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(lost).alias("linhas_sem_centro"),
        F.count_distinct(F.when(lost, F.col(KEY))).alias("chaves_sem_centro"),
        F.count_if(F.col(ORIGINAL_KEY) != F.col(KEY)).alias("linhas_corrigidas"),
        F.count_if(F.col(measure).isNull()).alias("valores_ausentes"),
        (F.count_if(complete) - F.count_distinct(*by)).alias("linhas_fundidas"),
    )


def usable(df: DataFrame, column: str = "CODCCUSTO") -> bool:
    """Whether a flow produced any row with a cost centre (stops at the first one)."""
    if column not in df.columns:
        return False
    return not df.filter(F.col(column).isNotNull()).isEmpty()
