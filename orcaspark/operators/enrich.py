"""Cost-centre structure and the enrichment of planned and committed amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from orcaspark.functions import drop_last_segment, strip_ws
from orcaspark.functions.numbers import AMOUNT_SUM
from orcaspark.operators.keys import KEY, KEY_PARTS, MATCH_KEYS, ORIGINAL_KEY, apply_corrections, prepare_keys, with_year
from orcaspark.operators.rows import first_by_key, lookup_join, not_null

PROJECT_LENGTH = 5
ACTION_LENGTH = 12
LEAF_LENGTH = 15

CONSOLIDATION_KEYS = [
    "ANO",
    "MES",
    "CODCCUSTO",
    "PROJETO",
    "ACAO",
    "Codigo_Natureza_Orcamentaria",
    "Descricao_PPA",
]
FINAL_COLUMNS = [
    "ANO",
    "MES",
    "PROJETO",
    "ACAO",
    "UNIDADE",
    "CODCCUSTO",
    "Valor_Ajustado",
    "Codigo_Natureza_Orcamentaria",
    "Descricao_Natureza_Orcamentaria",
    "Descricao_PPA",
    "DTUNIDADE",
    "DTPROJETO",
    "DTACAO",
]


def flatten_cost_centers(nodes: DataFrame) -> DataFrame:
    """One row per leaf cost centre with the names and dates of its project and action.

    Leaves are codes longer than 15 characters; their first 5 and 12 characters
    name the parent nodes. The parent sides keep only codes that short.
    """
    length = F.length(F.rtrim("CODCCUSTO"))
    code = F.rtrim("CODCCUSTO")

    def parents(width: int, name: str, created: str) -> DataFrame:
        return nodes.filter(length <= width).select(
            code.alias(f"_{name}"),
            F.col("CAMPOLIVRE").alias(name),
            F.col("RECCREATEDON").alias(created),
        )

    leaves = nodes.filter(length > LEAF_LENGTH).select(
        "CODCCUSTO",
        F.col("CAMPOLIVRE").alias("UNIDADE"),
        F.col("RECCREATEDON").alias("DTUNIDADE"),
        F.rtrim(F.left("CODCCUSTO", F.lit(PROJECT_LENGTH))).alias("_PROJETO"),
        F.rtrim(F.left("CODCCUSTO", F.lit(ACTION_LENGTH))).alias("_ACAO"),
    )
    return (
        leaves.join(parents(PROJECT_LENGTH, "PROJETO", "DTPROJETO"), "_PROJETO", "left")
        .join(parents(ACTION_LENGTH, "ACAO", "DTACAO"), "_ACAO", "left")
        .select("CODCCUSTO", "ACAO", "PROJETO", "UNIDADE", "DTUNIDADE", "DTPROJETO", "DTACAO")
    )


def committed_items(header: DataFrame, item: DataFrame, year: int) -> DataFrame:
    """Positive committed amounts of one year per cost-centre code and month."""
    return (
        header.filter(F.col("ANOORCAMENTO") == year)
        .join(item.filter(F.col("VALOROPCIONAL1") > 0), ["CODCOLIGADA", "IDORCAMENTO"])
        .select(
            "CODCCUSTO",
            F.col("ANOORCAMENTO").alias("ANO"),
            F.col("SEQITMORCA").alias("MES"),
            F.col("VALOROPCIONAL1").alias("COMPROMETIDO"),
        )
    )


def unique_reference(reference: DataFrame) -> DataFrame:
    """One cost centre per project, action, unit and year: the smallest code."""
    return first_by_key(reference, MATCH_KEYS, [F.col("CODCCUSTO")])


def enrich_planned(prepared: DataFrame, reference: DataFrame) -> DataFrame:
    """Attach the cost centre of each planned row's keys; unmatched rows keep a null one.

    Columns of the reference that the planned rows already have are left out.
    """
    own = set(prepared.columns)
    extra = [c for c in reference.columns if c not in own and c not in (KEY, ORIGINAL_KEY)]
    unique = unique_reference(reference).select(*MATCH_KEYS, *extra)
    return lookup_join(prepared, unique, MATCH_KEYS)


def enrich_committed(
    committed: DataFrame, reference: DataFrame, allocate: str = "all"
) -> DataFrame:
    """Attach the leaves of each commitment's truncated cost-centre code.

    A truncated code with several leaves repeats the amount on each of them
    (``allocate="all"``); ``allocate="first"`` puts it on the smallest leaf.
    Commitments without a leaf, or whose leaf has no project, are dropped.
    """
    if allocate not in ("all", "first"):
        raise ValueError("allocate must be 'all' or 'first'")
    leaves = reference.select(
        drop_last_segment(F.col("CODCCUSTO")).alias("_truncado"),
        "PROJETO",
        "ACAO",
        "UNIDADE",
        "CODCCUSTO",
    ).filter(F.col("PROJETO").isNotNull())
    booked = committed.withColumn("_truncado", strip_ws(F.col("CODCCUSTO"))).drop("CODCCUSTO")
    if allocate == "first":
        first = first_by_key(leaves, ["_truncado"], [F.col("CODCCUSTO")])
        return lookup_join(booked, first, ["_truncado"], "inner").drop("_truncado")
    return booked.join(leaves, "_truncado").drop("_truncado")


def planned_flow(planned_raw: DataFrame, reference: DataFrame, corrections: DataFrame) -> DataFrame:
    """Prepare keys, apply corrections, attach cost centres."""
    return enrich_planned(apply_corrections(prepare_keys(planned_raw), corrections), reference)


def committed_flow(
    committed: DataFrame, reference: DataFrame, corrections: DataFrame, allocate: str = "all"
) -> DataFrame:
    """Attach cost centres, prepare keys, apply corrections.

    Keys depend on the commitment's code and year alone, so they are made once for each of these;
    the join that repeats the amounts comes last and its rows are not shuffled.
    """
    committed = with_year(committed)
    codes = committed.select(
        "CODCCUSTO", "ANO", F.col("CODCCUSTO").alias("_codigo"), F.col("ANO").alias("_ano_lido")
    ).distinct()
    keyed = apply_corrections(prepare_keys(enrich_committed(codes, reference, allocate)), corrections)
    amounts = committed.withColumnsRenamed({"CODCCUSTO": "_do_codigo", "ANO": "_do_ano"})
    same = (F.col("_do_codigo") == F.col("_codigo")) & F.col("_do_ano").eqNullSafe(F.col("_ano_lido"))
    own = [c for c in committed.columns if c != "CODCCUSTO"]
    return amounts.join(keyed, same).select(KEY, *own, *KEY_PARTS, "CODCCUSTO", ORIGINAL_KEY)


def committed_totals(committed: DataFrame) -> DataFrame:
    """Commitments summed by everything but the amount, before they repeat on the leaves of their code."""
    by = [c for c in committed.columns if c != "COMPROMETIDO"]
    return committed.groupBy(*by).agg(F.sum("COMPROMETIDO").cast(AMOUNT_SUM).alias("COMPROMETIDO"))


def consolidate_committed(
    committed: DataFrame, reference: DataFrame, corrections: DataFrame, allocate: str = "all"
) -> DataFrame:
    """Consolidated committed flow. Amounts are summed before the join that repeats them, and once more after it."""
    return consolidate(committed_flow(committed_totals(committed), reference, corrections, allocate))


def correct_again(enriched: DataFrame, reference: DataFrame, corrections: DataFrame) -> DataFrame:
    """Second pass after new corrections were accepted: repair the keys, join afresh."""
    attached = [c for c in reference.columns if c not in (*MATCH_KEYS, KEY, ORIGINAL_KEY)]
    return enrich_planned(apply_corrections(enriched.drop(*attached), corrections), reference)


def consolidate(
    enriched: DataFrame,
    keys: Sequence[str] = tuple(CONSOLIDATION_KEYS),
    columns: Sequence[str] = tuple(FINAL_COLUMNS),
) -> DataFrame:
    """One row per key among ``keys`` present: numbers summed, other columns their minimum.

    Rows lacking a key value (so every row without cost centre) are left out.
    Amounts are first summed by keys and other columns together, where hash
    aggregation with map-side partial sums applies; the text minimum, which needs
    a sort, then sees only those sums.
    """
    if "COMPROMETIDO" in enriched.columns:
        enriched = enriched.withColumnRenamed("COMPROMETIDO", "Valor_Ajustado")
    by = [c for c in keys if c in enriched.columns]
    kept = [c for c in columns if c in enriched.columns]
    rest = [f for f in enriched.select(*kept).schema.fields if f.name not in by]
    amounts = [f.name for f in rest if isinstance(f.dataType, NumericType)]
    others = [f.name for f in rest if f.name not in amounts]
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast(AMOUNT_SUM).alias(c) for c in amounts]
    rows = not_null(enriched, *by)
    if others:
        rows = rows.groupBy(*by, *others).agg(*sums)
    return rows.groupBy(*by).agg(*sums, *[F.min(c).alias(c) for c in others]).select(*kept)
