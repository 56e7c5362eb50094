import json
from decimal import Decimal

import pytest
from conftest import SF, as_dicts
from pyspark.sql import functions as F

from orcaspark.operators import correlate, reports, units
from orcaspark.operators.base import unit_names
from orcaspark.plans import registry
from orcaspark.session import stage

BASE = (
    "UNIDADE_FINAL string, tipo_projeto string, PROJETO string, ACAO string, NATUREZA_FINAL string,"
    " MES int, Valor_Planejado decimal(28,2), Valor_Executado decimal(28,2)"
)
UNIT_FRAME = [
    ("Projeto Saldo Alto", "Compartilhado", "Ação 1", 100000, 50000),
    ("Projeto Saldo Alto", "Compartilhado", "Ação 2", 50000, 20000),
    ("Projeto Saldo Alto", "Compartilhado", "Ação 3", 25000, 5000),
    ("Projeto Saldo Baixo", "Compartilhado", "Ação 4", 80000, 75000),
    ("Projeto Saldo Baixo", "Compartilhado", "Ação 5", 20000, 15000),
    ("Projeto Exclusivo A", "Exclusivo", "Ação Exclusiva 1", 60000, 30000),
    ("Projeto Exclusivo A", "Exclusivo", "Ação Exclusiva 2", 40000, 20000),
    ("Projeto Executado a Mais", "Exclusivo", "Ação Extra", 0, 10000),
]


def row(unit="U", kind="Exclusivo", project="P", action="A", nature="N", month=1, plan=0, spent=0):
    return (unit, kind, project, action, nature, month, Decimal(plan), Decimal(spent))


@pytest.fixture
def unit_frame(rows):
    return rows([row("U", t, p, a, "N", 1, x, y) for p, t, a, x, y in UNIT_FRAME], BASE)


def test_idle_budget(unit_frame):
    found = as_dicts(reports.idle_budget(unit_frame).orderBy("posicao"))
    assert [(r["PROJETO"], r["exclusivo"], r["compartilhado"]) for r in found] == [
        ("Projeto Saldo Alto", 0, 100000),
        ("Projeto Exclusivo A", 50000, 0),
        ("Projeto Saldo Baixo", 0, 10000),
    ]


def test_idle_budget_details(unit_frame):
    found = {r["PROJETO"]: r["detalhes"] for r in as_dicts(reports.idle_budget_report(unit_frame))}
    assert found["Projeto Saldo Alto"] == ["- Ação 1: R$ 50.0 k", "- Ação 2: R$ 30.0 k", "- Ação 3: R$ 20.0 k"]
    assert found["Projeto Saldo Baixo"] == ["- Ação 4: R$ 5.0 k", "- Ação 5: R$ 5.0 k"]


def test_idle_budget_keeps_seven_with_ties_by_name_per_unit(rows):
    data = [row(u, project=f"p{i}", plan=5) for u in "UV" for i in range(9)]
    data += [row("U", project=None, plan=99), row("W", project="over", plan=1, spent=2)]
    found = as_dicts(reports.idle_budget(rows(data, BASE)))
    assert sorted((r["UNIDADE_FINAL"], r["PROJETO"]) for r in found) == [
        (u, f"p{i}") for u in "UV" for i in range(7)
    ]


def test_balance_of_a_project_counts_rows_without_action(rows):
    data = [row(plan=10), row(action=None, plan=0, spent=4)]
    found = as_dicts(reports.idle_budget(rows(data, BASE)))[0]
    assert found["exclusivo"] == 6


def test_kpi(unit_frame, rows):
    found = as_dicts(reports.kpi(unit_frame))[0]
    assert found["total_planejado"] == 375000 and found["total_executado"] == 225000
    assert found["total_perc"] == 60.0
    assert found["exclusivo_planejado"] + found["compartilhado_planejado"] == 375000
    names = rows([("U", "Unidade")], "UNIDADE_FINAL string, nome_novo string")
    text = as_dicts(reports.kpi_text(unit_frame, names))[0]
    assert text["total_valores"] == "R$ 225.0 k de R$ 375.0 k"
    assert text["exclusivo_perc"] == "60.0%" and text["nome_novo"] == "Unidade"
    none = as_dicts(reports.kpi(rows([row(kind="Compartilhado", plan=0, spent=5)], BASE)))[0]
    assert none["exclusivo_perc"] == 0 and none["exclusivo_planejado"] == 0
    assert none["total_perc"] == 0


def test_trend_has_twelve_months(rows):
    data = [row(month=2, spent=5), row(month=2, kind="Compartilhado", spent=7), row(month=None, spent=9)]
    found = as_dicts(reports.trend(rows(data, BASE)).orderBy("MES"))
    assert [r["rotulo"] for r in found][:2] == ["Jan", "Fev"] and len(found) == 12
    assert [(r["exclusivo"], r["compartilhado"], r["total"]) for r in found][:3] == [
        (0, 0, 0), (5, 7, 12), (0, 0, 0),
    ]


def test_treemap(rows):
    data = [row(project=p, spent=s) for p, s in (("a", 10), ("b", 30), ("c", 30), ("d", 20), ("e", -5))]
    data += [row(nature="only negative", spent=-1), row(nature=None, spent=9), row(project=None, spent=9)]
    found = as_dicts(reports.treemap(rows(data, BASE)))
    assert [(r["NATUREZA_FINAL"], r["Valor_Executado"]) for r in found] == [("N", 90)]
    assert found[0]["projetos"] == "- b (R$ 30.00)<br>- c (R$ 30.00)<br>- d (R$ 20.00)"


def test_unplanned_spending(rows):
    data = [
        row(project="a", spent=10), row(project="b", spent=30), row(project="b", plan=-1),
        row(project="planned", plan=1, spent=50),
        row(nature="M", kind="Compartilhado", project="c", spent=99),
    ]
    found = as_dicts(reports.unplanned(rows(data, BASE)))
    assert [(r["NATUREZA_FINAL"], r["Valor_Executado"], r["alerta"]) for r in found] == [
        ("M", 99, "aviso"), ("N", 40, "perigo"),
    ]
    assert found[1]["projetos"] == ["- b: R$ 30.00", "- a: R$ 10.00"]


def test_sunburst_and_heatmap(rows):
    data = [
        row(project="p", nature="n1", plan=100, spent=50),
        row(project="p", nature="n2", plan=300, spent=30),
        row(project="p", nature="n3", plan=0, spent=1000),
        row(project="q", nature="n1", kind="Compartilhado", plan=1, spent=1),
    ]
    df = rows(data, BASE)
    levels = {(r["rotulo"], r["pai"]): (r["valor"], r["perc_exec"]) for r in as_dicts(reports.sunburst(df))}
    assert levels == {("n1", "p"): (100, 50.0), ("n2", "p"): (300, 10.0), ("p", ""): (400, 20.0)}
    wide = as_dicts(reports.heatmap_pivot(df, ["n1", "n2", "n3"]))
    assert wide == [{"UNIDADE_FINAL": "U", "PROJETO": "p", "n1": 50.0, "n2": 10.0, "n3": None}]
    with pytest.raises(ValueError, match="n2"):
        reports.heatmap_pivot(df, ["n1", "n3"])


@pytest.mark.parametrize(
    ("plan_month", "spend_month", "delay"),
    [(2, 5, 3), (5, 5, None), (5, 2, None), (0, 5, None), (2, 0, None), (2, None, None)],
)
def test_inertia(rows, plan_month, spend_month, delay):
    data = [row(month=plan_month, plan=1)]
    data += [] if spend_month is None else [row(month=spend_month, spent=1)]
    data += [row(month=9, plan=1, spent=1), row(month=1, plan=-5, spent=0)] if delay else []
    found = [r["inercia_meses"] for r in as_dicts(reports.inertia(rows(data, BASE)))]
    assert found == ([] if delay is None else [delay])


def test_worst_inertia_breaks_ties_by_project_and_action(rows):
    data = []
    for project, action in (("b", "a"), ("a", "z"), ("a", "y")):
        data += [row(project=project, action=action, month=1, plan=1),
                 row(project=project, action=action, month=4, spent=1)]
    found = as_dicts(reports.inertia_worst(rows(data, BASE)))
    assert [(r["PROJETO"], r["ACAO"], r["inercia_meses"]) for r in found] == [("a", "y", 3)]


def test_nested_top(rows):
    data = [row(nature=f"n{i}", project=f"p{j}", spent=100 * i + j + 1) for i in range(7) for j in range(4)]
    found = as_dicts(reports.nested_top(rows(data, BASE)))
    assert len(found) == 15
    assert {r["NATUREZA_FINAL"] for r in found} == {f"n{i}" for i in range(2, 7)}
    first = next(r for r in found if r["posicao_natureza"] == 1 and r["posicao_projeto"] == 1)
    assert (first["NATUREZA_FINAL"], first["PROJETO"], first["texto"]) == ("n6", "p3", "R$ 604.00")


def test_reports_agree_on_base_and_cube(spark):
    base = registry.base(spark, SF)
    cube = reports.report_cube(base)
    for report in (reports.kpi, reports.treemap, reports.idle_budget, reports.unplanned,
                   reports.sunburst, reports.inertia, reports.trend, reports.nested_top):
        left, right = report(base), report(cube)
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty(), report.__name__


def test_every_report_is_empty_on_no_rows(rows):
    df = rows([], BASE)
    for report in (reports.kpi, reports.trend, reports.treemap, reports.idle_budget_report,
                   reports.unplanned, reports.sunburst, reports.heatmap, reports.inertia_worst,
                   reports.nested_top, reports.report_cube):
        assert report(df).isEmpty(), report.__name__


def test_unit_documents(rows, unit_frame):
    df = unit_frame.union(rows([row("V", spent=5)], BASE))
    names = unit_names(df, rows([], "unidade string, nome_novo string"))
    cube = reports.report_cube(df)
    found = {r["unit_slug"]: json.loads(r["documento"]) for r in as_dicts(units.unit_documents(cube, names))}
    assert set(found) == {"U", "V"}
    u = found["U"]
    assert len(u["trend"]["labels"]) == 12 and u["trend"]["total"][0] == 225000
    assert u["idle_budget"]["labels"] == ["Projeto Saldo Alto", "Projeto Exclusivo A", "Projeto Saldo Baixo"]
    assert u["idle_budget"]["values_exclusivo"] == [0, 50000, 0]
    assert u["idle_budget"]["detalhes_exclusivo"][0] == []
    assert u["treemap_exclusivo"]["parents"] == [""]
    assert u["unplanned_exclusivo"]["labels"] == ["N"] or "unplanned_exclusivo" not in u
    assert "idle_budget" not in found["V"]
    assert found["V"]["unplanned_exclusivo"]["projetos"] == [["- P: R$ 5.00"]]


CENTERS = "UNIDADE_FINAL string, tipo_projeto string, CODCCUSTO string"


def test_top_suppliers_of_exclusive_projects(rows):
    base = rows([("U", "Exclusivo", "c1 "), ("U", "Compartilhado", "c2"), ("U", "Exclusivo", None)], CENTERS)
    data = [("c1", 1, f"f{i:02}", Decimal(i + 1)) for i in range(25)]
    data += [("c1", 2, "f00", Decimal(100)), ("c2", 1, "x", Decimal(999)), ("c1", 1, None, Decimal(999))]
    suppliers = rows(data, "CC string, MES int, FORNECEDOR string, VALOR decimal(28,2)")
    found = as_dicts(correlate.top_suppliers(suppliers, base).orderBy("posicao"))
    assert len(found) == 20
    assert [r["FORNECEDOR"] for r in found[:2]] == ["f00", "f24"] and found[0]["texto"] == "R$ 101.00"
    assert correlate.supplier_extract(suppliers, base).count() == 27
    assert correlate.top_suppliers(suppliers, base.filter("CODCCUSTO = 'c2'")).isEmpty()


def test_commitments_match_truncated_centers_and_the_year(rows):
    base = rows([("U", "Exclusivo", "1.2.3"), ("U", "Exclusivo", "1.2.4"), ("V", "x", "1.2.3"),
                 ("U", "x", "nodot")], CENTERS)
    booked = rows([(" 1.2 ", "2025.0", 5), ("1.2", "2024", 6), ("nodot", "2025", 7), ("1.2", "x", 8)],
                  "CODCCUSTO string, ANO string, SALDO int")
    found = as_dicts(correlate.committed_extract(booked, base, 2025).orderBy("UNIDADE_FINAL"))
    assert [(r["UNIDADE_FINAL"], r["CODCCUSTO"], r["SALDO"]) for r in found] == [("U", "1.2", 5), ("V", "1.2", 5)]
    assert correlate.with_money_texts(booked).filter("SALDO = 'R$ 5.00'").count() == 1
    with pytest.raises(KeyError):
        correlate.correlate(booked.drop("CODCCUSTO"), base)


def test_top_rows_under_one_hot_group(spark):
    """All cells in one unit and nature: the top is exact and limited before the shuffle."""
    cells = spark.range(20_000).select(
        F.lit("U").alias("UNIDADE_FINAL"), F.lit("Exclusivo").alias("tipo_projeto"),
        F.concat(F.lit("p"), F.col("id")).alias("PROJETO"), F.lit("A").alias("ACAO"),
        F.lit("N").alias("NATUREZA_FINAL"), F.lit(1).alias("MES"),
        F.lit(0).cast("decimal(28,2)").alias("Valor_Planejado"),
        F.col("id").cast("decimal(28,2)").alias("Valor_Executado"),
    )
    found = reports.treemap_detail(stage(cells, "cells"))
    assert [r["PROJETO"] for r in as_dicts(found.orderBy("posicao"))] == ["p19999", "p19998", "p19997"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2
