"""The two whole runs: enrichment of the source tables, and the unit reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orcaspark.operators import correlate, reports, units
from orcaspark.operators.base import unit_names
from orcaspark.operators.enrich import (
    CONSOLIDATION_KEYS,
    committed_flow,
    committed_totals,
    consolidate,
    correct_again,
    flatten_cost_centers,
    planned_flow,
)
from orcaspark.operators.keys import prepare_keys, unmatched_keys
from orcaspark.operators.ledger import supplier_month
from orcaspark.operators.quality import usable
from orcaspark.operators.repair import suggest_corrections
from orcaspark.operators.reports import report_cube
from orcaspark.operators.rows import rejected
from orcaspark.plans.analysis import DEFAULT_PPA, DEFAULT_YEAR, Sides, build_base
from orcaspark.session import stage, staging, tune
from orcaspark.sinks.extracts import write_brazilian_csv, write_unit_documents, write_unit_extracts
from orcaspark.sinks.tables import upsert
from orcaspark.sources.versioned import VersionedTable


@dataclass
class Enriched:
    """Saved tables after a run; ``None`` if a table never had a usable row."""

    planned: DataFrame | None
    committed: DataFrame | None
    suggestions: DataFrame
    rejected_planned: DataFrame
    rejected_committed: DataFrame


#: Plan label of planned rows without one: a load needs complete keys, and no amount is lost.
NO_PLAN = "SEM PPA"


def save(enriched: DataFrame, table: VersionedTable) -> tuple[DataFrame | None, DataFrame]:
    """Consolidate an enriched flow and upsert it by the consolidation keys present.

    Rows without a plan label are saved under ``NO_PLAN``. Returns the table and the rows
    left out for another missing key, which are also written beside it.
    """
    if "Descricao_PPA" in enriched.columns:
        enriched = enriched.fillna({"Descricao_PPA": NO_PLAN})
    keys = [c for c in CONSOLIDATION_KEYS if c in enriched.columns]
    left_out = written(rejected(enriched, *keys), f"{table.root}/rejeitados")
    if usable(enriched):
        rows = consolidate(enriched)
        upsert(table, rows, [c for c in CONSOLIDATION_KEYS if c in rows.columns])
    return table.read(), left_out


def run_enrichment(
    spark: SparkSession,
    planned_raw: DataFrame,
    cost_center_raw: DataFrame,
    committed: DataFrame,
    corrections: DataFrame,
    out: str,
    accepted: DataFrame | None = None,
) -> Enriched:
    """Resolve planned and committed amounts to cost centres and save both under ``out``.

    The prepared cost-centre reference serves both flows and each flow several
    readers, so they are staged once, in a scope: nothing stays in the staging folder. The
    suggestions are written under ``out`` as well. ``accepted`` holds reviewed repairs
    (``ChaveQuebrada, ChaveCorreta``): the planned rows get a second pass with them, and
    the suggestions are for what is still unmatched.
    """
    tune(spark)
    with staging(spark):
        reference = stage(prepare_keys(flatten_cost_centers(cost_center_raw)), "centros")
        planned = stage(planned_flow(planned_raw, reference, corrections), "planejado")
        if accepted is not None:
            planned = stage(correct_again(planned, reference, accepted), "planejado")
        booked = stage(committed_flow(committed_totals(committed), reference, corrections), "comprometido")
        saved, no_centre = save(planned, VersionedTable(spark, f"{out}/planejado_com_centro"))
        saved_booked, no_leaf = save(booked, VersionedTable(spark, f"{out}/comprometido_com_centro"))
        suggestions = suggest_corrections(unmatched_keys(planned, reference), reference)
        suggestions = written(suggestions, f"{out}/sugestoes")
    return Enriched(saved, saved_booked, suggestions, no_centre, no_leaf)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a place of its own and read from there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_reports(
    sides: Sides,
    ledger: DataFrame,
    committed: DataFrame,
    unit_map: DataFrame,
    directory: DataFrame,
    out: str,
    year: int = DEFAULT_YEAR,
    strict: bool = False,
) -> None:
    """Write every unit's detail rows, correlations and chart document, and the flat CSV.

    ``sides`` holds the year's staged planned and executed rows
    (``analysis.both_sides``). All units are written in the same few jobs.
    """
    tune(ledger.sparkSession)
    with staging(ledger.sparkSession):
        base = stage(build_base(sides, unit_map, strict=strict), "base")
        names = stage(unit_names(base, directory), "unidades")
        cube = stage(report_cube(base), "cubo")
        write_unit_extracts(base, names, f"{out}/dados_analiticos")
        suppliers = correlate.supplier_extract(supplier_month(ledger, year), base)
        write_unit_extracts(suppliers, names, f"{out}/correlacao_fornecedores")
        booked = correlate.committed_extract(committed, base, year)
        write_unit_extracts(booked, names, f"{out}/correlacao_comprometido")
        write_unit_documents(units.unit_documents(cube, names), f"{out}/graficos")
        tables = {
            "indicadores": reports.kpi_text(base, names),
            "hierarquia": reports.sunburst(base),
            "mapa_de_execucao": reports.heatmap(base),
            "inercia": reports.inertia_worst(base),
            "maiores_fornecedores": correlate.top_suppliers(supplier_month(ledger, year), base),
        }
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{out}/{name}")
        write_brazilian_csv(base, f"{out}/relatorio_final")


__all__ = ["DEFAULT_PPA", "DEFAULT_YEAR", "Enriched", "run_enrichment", "run_reports", "save"]
