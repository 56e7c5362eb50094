"""One chart document per unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orcaspark.functions import slug
from orcaspark.operators import reports
from orcaspark.operators.base import EXCLUSIVE, SHARED
from orcaspark.operators.reports import EXECUTED, NATURE, PROJECT, TYPE, UNIT


def _lists(rows: DataFrame, order: list[Column], fields: dict[str, Column], name: str) -> DataFrame:
    """Sorted rows of each unit as parallel lists in one struct column."""
    item = F.struct(
        *[c.alias(f"o{i}") for i, c in enumerate(order)],
        *[c.alias(field) for field, c in fields.items()],
    )
    grouped = rows.groupBy(UNIT).agg(F.array_sort(F.collect_list(item)).alias("_itens"))
    lists = [F.col(f"_itens.{field}").alias(field) for field in fields]
    return grouped.select(UNIT, F.struct(*lists).alias(name))


def _per_type(rows: DataFrame, order: list[Column], fields: dict[str, Column], name: str) -> list:
    return [
        _lists(rows.filter(F.col(TYPE) == project_type), order, fields, f"{name}_{suffix}")
        for project_type, suffix in ((EXCLUSIVE, "exclusivo"), (SHARED, "compartilhado"))
    ]


#: Blocks of a document and the list of each that goes with its labels.
BLOCK_VALUES = {
    "trend": "total",
    "treemap_exclusivo": "values",
    "treemap_compartilhado": "values",
    "idle_budget": "values_exclusivo",
    "unplanned_exclusivo": "values",
    "unplanned_compartilhado": "values",
}


def document_rows(documents: DataFrame) -> DataFrame:
    """Documents read back: ``UNIDADE_FINAL, bloco, posicao`` (from 0), ``rotulo, valor``."""
    schema = ", ".join(f"{b}: struct<labels: array<string>, {v}: array<double>>" for b, v in BLOCK_VALUES.items())
    read = documents.select(UNIT, F.from_json("documento", f"struct<{schema}>").alias("d"))

    def entries(block: str, values: str) -> Column:
        pairs = F.arrays_zip(F.col(f"d.{block}.labels").alias("rotulo"), F.col(f"d.{block}.{values}").alias("valor"))
        placed = F.transform(pairs, lambda p, i: F.struct(F.lit(block).alias("bloco"), i.alias("posicao"), p["rotulo"].alias("rotulo"), p["valor"].alias("valor")))
        return F.coalesce(placed, F.array().cast("array<struct<bloco: string, posicao: int, rotulo: string, valor: double>>"))

    return read.select(UNIT, F.inline(F.concat(*[entries(b, v) for b, v in BLOCK_VALUES.items()])))


def unit_documents(cube: DataFrame, names: DataFrame) -> DataFrame:
    """``UNIDADE_FINAL, unit_slug, documento``: the chart data of each unit as JSON text.

    ``cube`` is read by six reports; pass a staged ``report_cube``. The lists of a
    document are bounded by its chart: 12 months, 7 projects, one entry per nature.
    """
    amount = F.col(EXECUTED).cast("double")
    blocks = [
        _lists(
            reports.trend(cube),
            [F.col("MES")],
            {
                "labels": F.col("rotulo"),
                "total": F.col("total").cast("double"),
                "exclusivo": F.col("exclusivo").cast("double"),
                "compartilhado": F.col("compartilhado").cast("double"),
            },
            "trend",
        ),
        *_per_type(
            reports.treemap(cube),
            [F.col(NATURE)],
            {
                "labels": F.col(NATURE),
                "parents": F.lit(""),
                "values": amount,
                "projetos": F.col("projetos"),
            },
            "treemap",
        ),
        _lists(
            reports.idle_budget_report(cube),
            [F.col("posicao")],
            {
                "labels": F.col(PROJECT),
                "values_exclusivo": F.col("exclusivo").cast("double"),
                "values_compartilhado": F.col("compartilhado").cast("double"),
                "detalhes_exclusivo": F.when(F.col(TYPE) == EXCLUSIVE, F.col("detalhes")).otherwise(
                    F.array().cast("array<string>")
                ),
                "detalhes_compartilhado": F.when(F.col(TYPE) == SHARED, F.col("detalhes")).otherwise(
                    F.array().cast("array<string>")
                ),
            },
            "idle_budget",
        ),
        *_per_type(
            reports.unplanned(cube),
            [-F.col(EXECUTED), F.col(NATURE)],
            {
                "labels": F.col(NATURE),
                "values": amount,
                "projetos": F.col("projetos"),
                "alerta": F.col("alerta"),
            },
            "unplanned",
        ),
    ]
    documents = names.select(UNIT, "nome_novo")
    fields = ["nome_novo"]
    for block in blocks:
        name = block.columns[1]
        documents = documents.join(block, UNIT, "left")
        fields.append(name)
    return documents.select(
        UNIT,
        slug(F.col("nome_novo")).alias("unit_slug"),
        F.to_json(F.struct(*fields)).alias("documento"),
    )
