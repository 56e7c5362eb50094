import json
import os

from conftest import SF, as_dicts
from pyspark.sql import functions as F

from orcaspark.plans import analysis, pipeline, registry
from orcaspark.session import staging_root
from orcaspark.sources import star


def test_enrichment_run(spark, tmp_path):
    out = str(tmp_path / "run")
    arguments = (
        star.planned_raw(spark, SF),
        star.cost_center_raw(spark, SF),
        registry.committed(spark, SF),
        star.corrections(spark, SF),
        out,
    )
    before_run = staged_folders(spark)
    result = pipeline.run_enrichment(spark, *arguments)
    want = registry.consolidate(spark, SF)
    assert result.planned.exceptAll(want).isEmpty() and result.planned.count() == want.count()
    before = result.committed.agg(F.sum("Valor_Ajustado")).first()
    again = pipeline.run_enrichment(spark, *arguments)
    assert again.committed.agg(F.sum("Valor_Ajustado")).first() == before
    assert again.planned.count() == want.count()
    assert not again.suggestions.isEmpty()
    left = [p for p in staged_folders(spark) if p not in before_run]
    assert not left  # the run deletes what it staged


def staged_folders(spark):
    root = staging_root(spark).removeprefix("file://")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_enrichment_run_without_usable_rows(spark, tmp_path):
    result = pipeline.run_enrichment(
        spark,
        star.planned_raw(spark, SF).limit(0),
        star.cost_center_raw(spark, SF),
        registry.committed(spark, SF).withColumn("CODCCUSTO", F.lit("unknown")),
        star.corrections(spark, SF),
        str(tmp_path / "run"),
    )
    assert result.planned is None and result.committed is None


def test_enrichment_run_saves_rows_without_plan_label_and_returns_rejects(spark, tmp_path):
    planned = star.planned_raw(spark, SF).withColumn(
        "Descricao_PPA", F.when(F.col("MES") > 6, F.col("Descricao_PPA"))
    )
    result = pipeline.run_enrichment(
        spark,
        planned,
        star.cost_center_raw(spark, SF),
        registry.committed(spark, SF),
        star.corrections(spark, SF),
        str(tmp_path / "run"),
    )
    assert not result.planned.filter(F.col("Descricao_PPA") == pipeline.NO_PLAN).isEmpty()
    kept = result.planned.agg(F.sum("Valor_Ajustado")).first()[0]
    left = result.rejected_planned.agg(F.coalesce(F.sum("Valor_Ajustado"), F.lit(0))).first()[0]
    assert abs(kept + left - planned.agg(F.sum("Valor_Ajustado")).first()[0]) < 0.01


def test_accepted_repairs_get_a_second_pass(spark, tmp_path):
    fixes = star.corrections(spark, SF)
    inputs = (star.planned_raw(spark, SF), star.cost_center_raw(spark, SF), registry.committed(spark, SF))
    rejects = [
        pipeline.run_enrichment(spark, *inputs, first, str(tmp_path / name), accepted).rejected_planned.count()
        for name, first, accepted in (("a", fixes.filter("false"), None), ("b", fixes.filter("false"), fixes), ("c", fixes, None))
    ]
    assert rejects[0] > rejects[1] == rejects[2]


def test_report_run(spark, tmp_path):
    sides = registry.sides(spark, SF)
    pipeline.run_reports(
        sides,
        star.ledger(spark, SF),
        registry.committed(spark, SF),
        star.unit_map(spark, SF),
        star.unit_directory(spark, SF),
        str(tmp_path),
        year=registry.YEAR,
    )
    units = {p.name for p in (tmp_path / "dados_analiticos").glob("unit_slug=*")}
    assert units == {p.name for p in (tmp_path / "graficos").glob("unit_slug=*")} and len(units) == 9
    base = analysis.build_base(sides, star.unit_map(spark, SF))
    assert spark.read.parquet(str(tmp_path / "dados_analiticos")).count() == base.count()
    document = next((tmp_path / "graficos").glob("*/*.txt")).read_text()
    assert json.loads(document)["trend"]["labels"][0] == "Jan"
    suppliers = spark.read.parquet(str(tmp_path / "correlacao_fornecedores"))
    assert suppliers.count() == registry.supplier_extract(spark, SF).count()
    for name in ("indicadores", "hierarquia", "mapa_de_execucao", "inercia", "maiores_fornecedores"):
        assert not spark.read.parquet(str(tmp_path / name)).isEmpty()
    assert as_dicts(spark.read.csv(str(tmp_path / "relatorio_final"), sep=";", header=True).limit(1))
