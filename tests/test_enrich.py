from datetime import datetime
from decimal import Decimal

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from orcaspark.operators import enrich, keys, quality

REFERENCE = "CODCCUSTO string, PROJETO string, ACAO string, UNIDADE string, ANO int"


def test_cost_center_hierarchy(rows):
    day = datetime(2024, 1, 2)
    nodes = rows(
        [
            ("00001.AAAAAA.0001", "unit", day),
            ("00001.AAAAAA   ", "padded action", day),
            ("00001", "project", day),
            ("00002.BBBBBB.0001", "orphan", day),
            ("123456789012345", "15 characters", day),
            ("1234567890123456", "16 characters", day),
        ],
        "CODCCUSTO string, CAMPOLIVRE string, RECCREATEDON timestamp",
    )
    found = {r["CODCCUSTO"]: r for r in as_dicts(enrich.flatten_cost_centers(nodes))}
    assert set(found) == {"00001.AAAAAA.0001", "00002.BBBBBB.0001", "1234567890123456"}
    whole = found["00001.AAAAAA.0001"]
    assert (whole["PROJETO"], whole["ACAO"], whole["UNIDADE"]) == ("project", "padded action", "unit")
    assert found["00002.BBBBBB.0001"]["PROJETO"] is None


def test_committed_items(rows):
    header = rows([(1, 7, "c", 2025), (1, 8, "d", 2024), (2, 7, "e", 2025)],
                  "CODCOLIGADA int, IDORCAMENTO bigint, CODCCUSTO string, ANOORCAMENTO int")
    item = rows([(1, 7, 3, 5.0), (1, 7, 4, 0.0), (1, 8, 1, 9.0), (2, 9, 1, 9.0)],
                "CODCOLIGADA int, IDORCAMENTO bigint, SEQITMORCA int, VALOROPCIONAL1 double")
    found = enrich.committed_items(header, item, 2025).collect()
    assert found == [("c", 2025, 3, 5.0)]


def prepared(rows):
    return keys.prepare_keys(
        rows(
            [("P", "A", "U", 2025, 1, Decimal("10.00")), ("Q", "A", "U", 2025, 1, Decimal("1.00"))],
            "PROJETO string, ACAO string, UNIDADE string, ANO int, MES int, Valor_Ajustado decimal(18,2)",
        )
    )


def test_planned_rows_take_the_smallest_matching_center(rows):
    reference = rows([("9", "P", "A", "U", 2025), ("1", "P", "A", "U", 2025)], REFERENCE)
    found = {r["PROJETO"]: r["CODCCUSTO"] for r in as_dicts(enrich.enrich_planned(prepared(rows), reference))}
    assert found == {"P": "1", "Q": None}


def test_commitments_spread_over_leaves_or_stay_on_the_first(rows):
    reference = rows(
        [("1.2.3", "P", "A", "U", 2025), ("1.2.4", "P", "A", "V", 2025), ("123", "R", "A", "W", 2025)],
        REFERENCE,
    )
    booked = rows([(" 1.2", 2025, 1, 5.0), ("123", 2025, 1, 7.0), ("9", 2025, 1, 9.0)],
                  "CODCCUSTO string, ANO int, MES int, COMPROMETIDO double")
    every = enrich.enrich_committed(booked, reference)
    assert sorted(r["CODCCUSTO"] for r in as_dicts(every)) == ["1.2.3", "1.2.4", "123"]
    first = enrich.enrich_committed(booked, reference, allocate="first")
    assert sorted(r["CODCCUSTO"] for r in as_dicts(first)) == ["1.2.3", "123"]
    with pytest.raises(ValueError):
        enrich.enrich_committed(booked, reference, allocate="half")


def test_second_pass_after_new_corrections(rows):
    reference = rows([("1", "P", "A", "U", 2025)], REFERENCE)
    none = rows([], "ChaveQuebrada string, ChaveCorreta string")
    first = enrich.enrich_planned(keys.apply_corrections(prepared(rows), none), reference)
    fix = rows([("Q|A|U|2025", "P|A|U|2025")], "ChaveQuebrada string, ChaveCorreta string")
    second = as_dicts(enrich.correct_again(first, reference, fix))
    assert [r["CODCCUSTO"] for r in second] == ["1", "1"]
    assert {r["CHAVE_CONCAT_original"] for r in second} == {"P|A|U|2025", "Q|A|U|2025"}


CONSOLIDATED = (
    "ANO int, MES int, CODCCUSTO string, PROJETO string, ACAO string, UNIDADE string,"
    " Codigo_Natureza_Orcamentaria string, Valor_Ajustado decimal(18,2), outro string"
)


def test_consolidation(rows):
    ten, one = Decimal("10.00"), Decimal("1.00")
    df = rows(
        [
            (2025, 1, "c", "P", "A", "V", "n", ten, "x"),
            (2025, 1, "c", "P", "A", "U", "n", one, "y"),
            (2025, 1, "c", "P", "A", None, "n", None, "y"),
            (2025, 1, "c", "P", "A", "U", None, ten, "y"),
            (2025, 1, None, "P", "A", "U", "n", ten, "y"),
            (2025, 2, "c", "P", "A", None, "n", None, "y"),
        ],
        CONSOLIDATED,
    )
    found = sorted(as_dicts(enrich.consolidate(df)), key=lambda r: r["MES"])
    assert [(r["MES"], r["UNIDADE"], r["Valor_Ajustado"]) for r in found] == [
        (1, "U", Decimal("11.00")),
        (2, None, Decimal("0.00")),
    ]
    assert "outro" not in found[0]


def test_consolidation_renames_the_committed_measure_and_uses_present_keys(rows):
    df = rows([(2025, 1, "c", "P", "A", 2.0), (2025, 1, "c", "P", "A", 3.0)],
              "ANO int, MES int, CODCCUSTO string, PROJETO string, ACAO string, COMPROMETIDO double")
    assert as_dicts(enrich.consolidate(df))[0]["Valor_Ajustado"] == Decimal("5.00")


def test_snapshots_of_different_plans_do_not_add_up(rows):
    df = rows([(2025, 1, "c", "P", "A", "n", ppa, 1.0) for ppa in ("PPA 1", "PPA 2")],
              "ANO int, MES int, CODCCUSTO string, PROJETO string, ACAO string,"
              " Codigo_Natureza_Orcamentaria string, Descricao_PPA string, Valor_Ajustado double")
    assert enrich.consolidate(df).count() == 2


def test_quality_counts(rows):
    reference = rows([("1", "P", "A", "U", 2025)], REFERENCE)
    none = rows([], "ChaveQuebrada string, ChaveCorreta string")
    twice = prepared(rows).union(prepared(rows))
    flow = enrich.enrich_planned(keys.apply_corrections(twice, none), reference)
    row = as_dicts(quality.quality_counts(flow))[0]
    assert row == {
        "linhas": 4,
        "linhas_sem_centro": 2,
        "chaves_sem_centro": 1,
        "linhas_corrigidas": 0,
        "valores_ausentes": 0,
        "linhas_fundidas": 1,
    }
    assert quality.usable(flow)
    assert not quality.usable(flow.filter("CODCCUSTO IS NULL"))
    assert not quality.usable(flow.drop("CODCCUSTO"))


def test_hot_keys_and_empty_inputs(spark, rows):
    """A third of all rows under one key gives the same totals; no rows give no rows."""
    n = 30_000
    df = spark.range(n).select(
        F.lit(2025).alias("ANO"),
        F.lit(1).alias("MES"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("CODCCUSTO"),
        F.lit("P").alias("PROJETO"),
        F.lit("A").alias("ACAO"),
        F.lit(1).cast("decimal(18,2)").alias("Valor_Ajustado"),
    )
    found = enrich.consolidate(df)
    assert found.agg(F.sum("Valor_Ajustado")).first()[0] == n
    assert found.filter("CODCCUSTO = 'hot'").first()["Valor_Ajustado"] == n // 3
    assert enrich.consolidate(df.limit(0)).isEmpty()


def test_amounts_are_repeated_by_the_last_join(rows, spark):
    reference = rows([("1.2.3", "P", "A", "U", 2025), ("1.2.4", "P", "A", "V", 2025)], REFERENCE)
    booked = rows([("1.2", 2025, 1, Decimal("5.00")), ("1.2", 2025, 1, Decimal("5.00")), ("1.2", None, 2, Decimal("7.00"))],
                  "CODCCUSTO string, ANO int, MES int, COMPROMETIDO decimal(18,2)")
    fixes = rows([("P|A|U|2025", "Q|A|U|2025")], "ChaveQuebrada string, ChaveCorreta string")
    flow = enrich.committed_flow(booked, reference, fixes)
    plain = keys.apply_corrections(keys.prepare_keys(enrich.enrich_committed(booked, reference)), fixes)
    assert flow.columns == plain.columns
    assert sorted(map(str, flow.collect())) == sorted(map(str, plain.collect())) and flow.count() == 6
    joins = [line for line in flow._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert "_codigo" in joins[0] and all("_codigo" not in line for line in joins[1:])
