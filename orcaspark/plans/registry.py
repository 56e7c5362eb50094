"""Named queries over the order-entry star schema.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables. Building one may
run jobs: inputs that feed several branches are staged first.
Amounts leave as double so that engines with other decimal rules compare equal.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType

from orcaspark.functions.dates import year_bounds
from orcaspark.lookups import EXPENSE_GROUPS, nature_names
from orcaspark.operators import base as categories
from orcaspark.operators import correlate, enrich, keys, ledger, merge, quality, reconcile, repair
from orcaspark.operators import reports, units
from orcaspark.operators.rows import READING_ORDER, rejected
from orcaspark.plans import loads
from orcaspark.plans.analysis import Sides, both_sides, build_base, planned_vs_executed
from orcaspark.session import stage, tune
from orcaspark.sinks.extracts import brazilian
from orcaspark.sources import star
from orcaspark.sources.lookup_files import json_map_rows
from orcaspark.sources.tables import empty

YEAR = 1997
PPA = f"PPA {YEAR}"
FILTER_PROJECT = "Brand#12"
NATURE_COLUMNS = {
    "Bens Móveis": "bens_moveis",
    "Serviços Especializados": "servicos_especializados",
    "Despesas Com Viagens": "despesas_com_viagens",
    "Aluguéis E Encargos": "alugueis_e_encargos",
    "Demais Custos E Despesas Gerais": "demais_custos",
    "RUBRICA LOCAL": "rubrica_local",
}

Query = Callable[[SparkSession, str], DataFrame]


def flat(df: DataFrame) -> DataFrame:
    """Decimals as double, text arrays as one text."""
    shown = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, ArrayType):
            c = F.array_join(c, "; ")
        shown.append(c.alias(f.name))
    return df.select(*shown)


def sides(spark: SparkSession, d: str) -> Sides:
    return both_sides(star.planned_enriched(spark, d, YEAR), star.ledger(spark, d), YEAR, PPA)


def base(spark: SparkSession, d: str) -> DataFrame:
    return build_base(sides(spark, d), star.unit_map(spark, d))


def reference(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    nodes = stage(star.cost_center_raw(spark, d, lines), "nos")
    return keys.prepare_keys(enrich.flatten_cost_centers(nodes))


def committed(spark: SparkSession, d: str) -> DataFrame:
    return enrich.committed_items(star.commit_header(spark, d, YEAR), star.commit_item(spark, d, YEAR), YEAR)


def fixes(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    """The corrections, written once: so small a table is broadcast, and the rows it corrects stay where they are."""
    return stage(star.corrections(spark, d, lines), "correcoes")


def corrected(spark: SparkSession, d: str, lines: DataFrame | None = None) -> DataFrame:
    lines = star.budget_lines(spark, d) if lines is None else lines
    prepared = keys.prepare_keys(star.planned_raw(spark, d, lines))
    return keys.apply_corrections(prepared, fixes(spark, d, lines))


def enriched(spark: SparkSession, d: str) -> DataFrame:
    lines = star.budget_lines(spark, d)
    return enrich.enrich_planned(corrected(spark, d, lines), reference(spark, d, lines))


def display_names(spark: SparkSession, d: str, df: DataFrame) -> DataFrame:
    return categories.unit_names(df, star.unit_directory(spark, d))


def executed_monthly(spark, d):
    return ledger.executed_monthly(star.ledger(spark, d), *year_bounds(YEAR))


def executed_semi(spark, d):
    groups = spark.createDataFrame([(g,) for g in EXPENSE_GROUPS], "DESCNVL1 string")
    return ledger.executed_monthly_of(star.ledger(spark, d), *year_bounds(YEAR), groups)


def supplier_month(spark, d):
    return ledger.supplier_month(star.ledger(spark, d), YEAR)


def cc_flatten(spark, d):
    return enrich.flatten_cost_centers(star.cost_center_raw(spark, d))


def key_spine(spark, d):
    both = sides(spark, d)
    return reconcile.key_spine(both.planned, both.executed)


def reconcile_five_keys(spark, d):
    return planned_vs_executed(sides(spark, d))


def reconcile_strict(spark, d):
    planned = reconcile.plan_snapshot(star.planned_enriched(spark, d, YEAR), PPA)
    return reconcile.reconcile_strict(planned, executed_monthly(spark, d))


def reconcile_accounts(spark, d):
    both = sides(spark, d)
    accounts = star.chart_of_accounts(spark, d)
    return reconcile.reconcile_accounts(both.planned, both.executed, accounts)


def reconcile_filtered(spark, d):
    rows = planned_vs_executed(sides(spark, d))
    return rows.filter(F.col("PROJETO") == FILTER_PROJECT).orderBy("MES", "CODCCUSTO")


def reconcile_function(spark, d):
    """The same through the SQL table function."""
    star.planned_enriched(spark, d, YEAR).createOrReplaceTempView("planejado_com_centro")
    star.ledger(spark, d).createOrReplaceTempView("razao")
    names = reconcile.nature_table(nature_names(spark))
    names.createOrReplaceTempView("naturezas_padrao")
    reconcile.register_reconcile_function(
        spark, "planejado_com_centro", "razao", "naturezas_padrao"
    )
    return spark.sql(
        "SELECT * FROM planejado_vs_executado(:inicio, :fim, :ppa)"
        " WHERE PROJETO = :projeto ORDER BY MES, CODCCUSTO",
        args=dict(zip(("inicio", "fim"), year_bounds(YEAR)), ppa=PPA, projeto=FILTER_PROJECT),
    )


def nature_lookup(spark, d):
    texts = star.ledger(spark, d).select(F.col("DESCNVL4").alias(reconcile.NATURE_TEXT))
    planned = star.planned_enriched(spark, d).select(reconcile.NATURE_TEXT)
    named = reconcile.with_standard_nature(texts.unionByName(planned))
    return named.groupBy(reconcile.NATURE_TEXT, "NATUREZA_FINAL").agg(
        F.count(F.lit(1)).alias("linhas")
    )


def prepare_keys(spark, d):
    return keys.prepare_keys(star.planned_raw(spark, d))


def prepare_keys_cube(spark, d):
    return keys.prepare_keys(star.planned_cube_extract(spark, d))


def prepare_reference(spark, d):
    return reference(spark, d)


def unmatched_keys(spark, d):
    lines = star.budget_lines(spark, d)
    return keys.unmatched_keys(corrected(spark, d, lines), reference(spark, d, lines))


def enrich_committed(spark, d):
    lines = star.budget_lines(spark, d)
    return enrich.committed_flow(committed(spark, d), reference(spark, d, lines), fixes(spark, d, lines))


def enrich_committed_first(spark, d):
    """Each commitment on one leaf only, so that amounts add up."""
    return enrich.enrich_committed(committed(spark, d), reference(spark, d), allocate="first")


def consolidate(spark, d):
    return enrich.consolidate(enriched(spark, d))


def consolidate_committed(spark, d):
    lines = star.budget_lines(spark, d)
    return enrich.consolidate_committed(committed(spark, d), reference(spark, d, lines), fixes(spark, d, lines))


def upsert(spark, d):
    """Plan of open lines merged into the plan of finished lines."""
    lines = star.planned_lines(spark, d)

    def plan(status: str) -> DataFrame:
        of_status = lines.filter(F.col("l_linestatus") == status)
        by = ["ANO", "MES", "PROJETO", "ACAO", "numero", "n_nationkey"]
        return star.with_center(star.summed(of_status, *by))

    return merge.merge_rows(plan("F"), plan("O"), ["ANO", "MES", "PROJETO", "ACAO", "CODCCUSTO"])


def unit_names(spark, d):
    return display_names(spark, d, base(spark, d))


def kpi_text(spark, d):
    rows = stage(base(spark, d).groupBy(reports.UNIT, reports.TYPE).agg(
        F.sum(reports.PLANNED).alias(reports.PLANNED),
        F.sum(reports.EXECUTED).alias(reports.EXECUTED),
    ), "kpi")
    return reports.kpi_text(rows, display_names(spark, d, rows))


def on_base(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: report(base(spark, d))


def report_cube(spark, d):
    cube = reports.report_cube(base(spark, d))
    months = ["MES_PLANEJADO", "MES_EXECUTADO"]
    return cube.withColumns({m: F.col(m).cast("double") for m in months})


def heatmap_pivot(spark, d):
    wide = reports.heatmap_pivot(base(spark, d), list(NATURE_COLUMNS))
    return wide.withColumnsRenamed(NATURE_COLUMNS)


def supplier_extract(spark, d):
    return correlate.supplier_extract(supplier_month(spark, d), base(spark, d))


def top_suppliers(spark, d):
    return correlate.top_suppliers(supplier_month(spark, d), base(spark, d))


def committed_correlation(spark, d):
    return correlate.committed_extract(committed(spark, d), base(spark, d), YEAR)


def suggest_corrections(spark, d):
    lines = star.budget_lines(spark, d)
    centers = stage(reference(spark, d, lines), "centros")
    failed = keys.unmatched_keys(corrected(spark, d, lines), centers)
    return repair.suggest_corrections(failed, centers)


def correct_again(spark, d):
    """Enriched without corrections, then once more with them."""
    lines = star.budget_lines(spark, d)
    prepared = keys.prepare_keys(star.planned_raw(spark, d, lines))
    known, centers = fixes(spark, d, lines), reference(spark, d, lines)
    first = enrich.enrich_planned(keys.apply_corrections(prepared, empty(spark, known.schema)), centers)
    return enrich.correct_again(first, centers, known)


def project_types(spark, d):
    return categories.project_types(sides(spark, d).pairs())


def unit_slice(spark, d):
    return categories.unit_slice(base(spark, d), " unidade africa ")


def base_rejects(spark, d):
    """Rows the reports by project and nature leave out."""
    return rejected(base(spark, d), reports.PROJECT, reports.NATURE)


def unit_directory(spark, d):
    return categories.directory_lookup(star.unit_directory(spark, d))


def read_twice(df: DataFrame, column: str) -> DataFrame:
    """A lookup whose every row stands twice, first with another text, with its reading order."""
    first = df.withColumn(column, F.concat(F.lit("ZZ "), F.col(column))).withColumn(READING_ORDER, F.lit(0))
    return first.unionByName(df.withColumn(READING_ORDER, F.lit(1)))


def last_unit_map(spark, d):
    """The last of a unit's rows counts."""
    return categories.unit_lookup(read_twice(star.unit_map(spark, d), "final"))


def last_unit_names(spark, d):
    directory = read_twice(star.unit_directory(spark, d), "nome_novo")
    return categories.unit_names(base(spark, d), directory)


def last_corrections(spark, d):
    return keys.unique_corrections(read_twice(star.corrections(spark, d), "ChaveCorreta"))


def money_texts(spark, d):
    return correlate.with_money_texts(committed(spark, d).withColumnRenamed("COMPROMETIDO", "SALDO"))


def correction_rebuild(spark, d):
    return keys.rebuild_corrections(enriched(spark, d))


def quality_counts(spark, d):
    return quality.quality_counts(enriched(spark, d))


def json_map(spark, d):
    events = star.table(spark, d, "events").select("event_id", "props")
    return json_map_rows(events, "props", keep=["event_id"])


def unit_json(spark, d):
    cube = stage(reports.report_cube(base(spark, d)), "cubo")
    return units.unit_documents(cube, display_names(spark, d, cube))


def extract_read(rows: Callable[[SparkSession, str, DataFrame], DataFrame], source: str = "parquet") -> Query:
    """Rows with a unit, made from the base, written to a folder a unit and read back."""

    def query(spark, d):
        whole = stage(base(spark, d), "base")
        return loads.extract_read(rows(spark, d, whole), display_names(spark, d, whole), source)

    return query


def documents_read(spark, d):
    return loads.documents_read(base(spark, d), lambda cube: display_names(spark, d, cube))


def enrichment_run(part: str) -> Query:
    """Part of the result of two whole runs in a row."""
    return lambda spark, d: getattr(loads.enrichment_run(spark, d, committed(spark, d)), part)


def queries() -> dict[str, Query]:
    plain: dict[str, Query] = {
        "executed_monthly": executed_monthly,
        "executed_semi": executed_semi,
        "supplier_month": supplier_month,
        "cc_flatten": cc_flatten,
        "committed_items": committed,
        "key_spine": key_spine,
        "reconcile": reconcile_five_keys,
        "reconcile_strict": reconcile_strict,
        "reconcile_accounts": reconcile_accounts,
        "reconcile_filtered": reconcile_filtered,
        "reconcile_function": reconcile_function,
        "nature_lookup": nature_lookup,
        "prepare_keys": prepare_keys,
        "prepare_keys_cube": prepare_keys_cube,
        "prepare_reference": prepare_reference,
        "apply_corrections": corrected,
        "enrich_planned": enriched,
        "unmatched_keys": unmatched_keys,
        "enrich_committed": enrich_committed,
        "enrich_committed_first": enrich_committed_first,
        "consolidate": consolidate,
        "consolidate_committed": consolidate_committed,
        "upsert": upsert,
        "analysis_base": base,
        "unit_names": unit_names,
        "kpi": on_base(reports.kpi),
        "kpi_text": kpi_text,
        "trend": on_base(reports.trend),
        "treemap": on_base(reports.treemap),
        "treemap_detail": on_base(reports.treemap_detail),
        "idle_budget": on_base(reports.idle_budget),
        "idle_budget_detail": on_base(reports.idle_budget_detail),
        "idle_budget_report": on_base(reports.idle_budget_report),
        "unplanned": on_base(reports.unplanned),
        "unplanned_detail": on_base(reports.unplanned_detail),
        "sunburst": on_base(reports.sunburst),
        "heatmap": on_base(reports.heatmap),
        "heatmap_pivot": heatmap_pivot,
        "inertia": on_base(reports.inertia),
        "inertia_worst": on_base(reports.inertia_worst),
        "nested_topk": on_base(reports.nested_top),
        "report_cube": report_cube,
        "supplier_extract": supplier_extract,
        "top_suppliers": top_suppliers,
        "committed_correlation": committed_correlation,
        "suggest_corrections": suggest_corrections,
        "correction_rebuild": correction_rebuild,
        "quality_counts": quality_counts,
        "correct_again": correct_again,
        "project_types": project_types,
        "unit_slice": unit_slice,
        "base_rejects": base_rejects,
        "unit_cost_centers": on_base(correlate.unit_cost_centers),
        "unit_directory": unit_directory,
        "last_unit_map": last_unit_map,
        "last_unit_names": last_unit_names,
        "last_corrections": last_corrections,
        "money_texts": money_texts,
        "brazilian_text": on_base(brazilian),
        "json_map_rows": json_map,
        "planned_scan": loads.planned_scan,
        "file_last_rows": loads.file_last_rows,
        "file_bad_lines": loads.file_bad_lines,
        "unit_map_file": loads.unit_map_file,
        "directory_file": loads.directory_file,
        "nature_file": loads.nature_file,
        "query_file": loads.query_file,
        "commitments_if_any": lambda spark, d: loads.commitments_if_any(committed(spark, d)),
        "corrections_if_any": loads.corrections_if_any,
        "usable_flows": lambda spark, d: loads.usable_flows(enriched(spark, d), enrich_committed(spark, d)),
        "upsert_written": loads.upsert_written,
        "upsert_keys_written": loads.upsert_keys_written,
        "snapshot_read": lambda spark, d: loads.snapshot_read(lambda: executed_monthly(spark, d)),
        "corrections_saved": loads.corrections_saved,
        "corrections_rebuilt": lambda spark, d: loads.corrections_rebuilt(enriched(spark, d)),
        "corrections_loaded": loads.corrections_loaded,
        "unit_extracts_read": extract_read(lambda spark, d, whole: whole),
        "supplier_extracts_read": extract_read(
            lambda spark, d, whole: correlate.supplier_extract(supplier_month(spark, d), whole)
        ),
        "committed_extracts_read": extract_read(
            lambda spark, d, whole: correlate.committed_extract(committed(spark, d), whole, YEAR)
        ),
        "documents_read": documents_read,
        "enrichment_run": enrichment_run("planned"),
        "enrichment_run_committed": enrichment_run("committed"),
        "enrichment_run_rejects": enrichment_run("rejected_planned"),
        "unit_json": unit_json,
        "unit_json_rows": lambda spark, d: units.document_rows(unit_json(spark, d)),
    }
    return {name: partial(_run, query) for name, query in plain.items()}


def _run(query: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(query(tune(spark), str(sf_dir).rstrip("/")))
