from datetime import date, datetime
from decimal import Decimal

from conftest import SF, as_dicts
from pyspark.sql import functions as F

from orcaspark.operators import base, ledger, reconcile
from orcaspark.plans import registry
from orcaspark.plans.analysis import both_sides
from orcaspark.sources import star

PLANNED = (
    "ANO int, MES int, PROJETO string, ACAO string, UNIDADE string, CODCCUSTO string,"
    " Codigo_Natureza_Orcamentaria string, Descricao_Natureza_Orcamentaria string,"
    " Valor_Ajustado decimal(18,2)"
)
EXECUTED = PLANNED.replace("Valor_Ajustado", "Valor_Executado")
LEDGER = (
    "DATA timestamp, PROJETO string, ACAO string, UNIDADE string, CC string, cdgContaNvl4 string,"
    " DESCNVL4 string, DESCNVL1 string, FORNECEDOR string, VALOR decimal(18,2)"
)


def d(text):
    return Decimal(text)


def test_executed_takes_whole_days_expense_groups_and_known_centers(rows):
    def post(when, cc="c", group="DESPESAS", value="1.00", unit="U"):
        return (when, "P", "A", unit, cc, "n", "t", group, "f", d(value))

    df = rows(
        [
            post(datetime(2025, 12, 31, 23, 59)),
            post(datetime(2025, 1, 1)),
            post(datetime(2024, 12, 31, 23, 59)),
            post(datetime(2025, 5, 5), cc=None),
            post(datetime(2025, 5, 5), group="RECEITAS"),
            post(datetime(2025, 12, 1), group="DESPESAS EXCLUSIVAS DO ORÇAMENTO", value="2.00"),
            post(datetime(2025, 12, 1), unit=None),
        ],
        LEDGER,
    )
    year = (date(2025, 1, 1), date(2025, 12, 31))
    found = {(r["MES"], r["UNIDADE"]): r["Valor_Executado"] for r in as_dicts(ledger.executed_monthly(df, *year))}
    assert found == {(12, "U"): d("3.00"), (1, "U"): d("1.00"), (12, None): d("1.00")}
    groups = rows([("DESPESAS",), ("DESPESAS",)], "DESCNVL1 string")
    assert ledger.executed_monthly_of(df, *year, groups).count() == 3
    months = ledger.supplier_month(df, 2025)
    assert months.agg(F.sum("VALOR")).first()[0] == d("6.00")


def test_five_key_match_repeats_amounts_and_strict_conserves_them(rows):
    planned = rows(
        [(2025, 1, "P", "A", "U", "c", "n", "Pessoal", d("10.00"))], PLANNED
    )
    executed = rows(
        [
            (2025, 1, "P", "A", "SP - U", "c", "n", "PESSOAL", d("4.00")),
            (2025, 1, "P", "A", "SP - U", "c", "n", "outro", d("1.00")),
        ],
        EXECUTED,
    )
    loose = as_dicts(reconcile.reconcile(planned, executed))
    assert len(loose) == 4  # two spellings of the unit, two texts
    assert sum(r["Valor_Planejado"] for r in loose) == d("40.00")
    strict = as_dicts(reconcile.reconcile_strict(planned, executed))
    assert len(strict) == 2
    assert sum(r["Valor_Planejado"] for r in strict) == d("10.00")
    assert sum(r["Valor_Executado"] for r in strict) == d("5.00")
    by_unit = {r["UNIDADE"]: r["NATUREZA_FINAL"] for r in strict}
    assert by_unit == {"U": "Pessoal", "SP - U": "Pessoal"}


def test_null_key_parts_keep_their_row_without_amounts(rows):
    planned = rows([(2025, 1, None, "A", "U", "c", "n", "t", d("10.00"))] * 2, PLANNED)
    executed = rows([(2025, 1, None, "A", "U", "c", "n", "t", d("4.00"))], EXECUTED)
    loose = as_dicts(reconcile.reconcile(planned, executed))
    assert [(r["Valor_Planejado"], r["Valor_Executado"]) for r in loose] == [(0, 0)]
    strict = as_dicts(reconcile.reconcile_strict(planned, executed))
    assert [(r["Valor_Planejado"], r["Valor_Executado"]) for r in strict] == [(d("20.00"), d("4.00"))]


def test_nature_texts_match_without_case_or_accents_and_never_duplicate(rows):
    texts = ["Bens Móveis", "BENS MÓVEIS", "bens moveis ", "Outra", None]
    df = rows([(t,) for t in texts], "Descricao_Natureza_Orcamentaria string")
    found = [r["NATUREZA_FINAL"] for r in as_dicts(reconcile.with_standard_nature(df))]
    assert sorted(map(str, found)) == sorted(["Bens Móveis"] * 3 + ["Outra", "None"])
    given = rows([("outra", "X", 1), ("OUTRÁ", "Y", 2)], "Descricao_Natureza_Orcamentaria string,"
                 " Descricao_Natureza_Orcamentaria_FINAL string, linha int")
    named = {r[0]: r["NATUREZA_FINAL"] for r in reconcile.with_standard_nature(df, given).collect()}
    assert named["Outra"] == "Y" and named["Bens Móveis"] == "Bens Móveis"


def test_accounts_name_rows_without_text_and_sort(rows):
    planned = rows(
        [
            (2025, 2, "P", "A", "U", "c", "3.1.a.b", None, d("1.00")),
            (2025, 1, "P", "A", "U", "c", "3.1.a.b", "own", d("1.00")),
        ],
        PLANNED,
    )
    accounts = rows([("3.1.A.B ", "named"), ("3.1", "short")], "CODCONTA string, DESCRICAO string")
    found = as_dicts(reconcile.reconcile_accounts(planned, rows([], EXECUTED), accounts))
    assert [r["Descricao_Natureza_Orcamentaria"] for r in found] == ["own", "named"]


def test_strict_totals_equal_the_inputs_on_the_star_schema(spark):
    both = both_sides(star.planned_enriched(spark, SF), star.ledger(spark, SF), registry.YEAR, registry.PPA)
    strict = reconcile.reconcile_strict(*both)
    total = strict.agg(F.sum("Valor_Planejado"), F.sum("Valor_Executado")).first()
    assert total[0] == both.planned.agg(F.sum("Valor_Ajustado")).first()[0]
    assert total[1] == both.executed.agg(F.sum("Valor_Executado")).first()[0]
    loose = reconcile.reconcile(*both)
    assert loose.agg(F.sum("Valor_Planejado")).first()[0] >= total[0]


def test_project_types_and_unit_names(rows):
    df = rows(
        [
            ("Projeto A", "UNIDADE 1", 100, 80, 1),
            ("Projeto A", "UNIDADE 2", 100, 70, 1),
            ("Projeto B", "SP - unidade 1 ", 50, 40, 2),
            ("Projeto B", "UNIDADE 1", 50, 40, 2),
            (None, "UNIDADE 1", 1, 1, 1),
            (None, "UNIDADE 2", 1, 1, 1),
            ("Projeto C", None, 1, 1, 1),
            ("Projeto C", "UNIDADE 1", 1, 1, 1),
        ],
        "PROJETO string, UNIDADE string, Valor_Planejado int, Valor_Executado int, MES int",
    )
    units = rows(
        [("UNIDADE 1", "UNIDADE FINAL 1"), (" unidade 2", "UNIDADE FINAL 2"), ("X", None)],
        "nm_unidade_padronizada string, final string",
    )
    found = as_dicts(base.analysis_base(df, units))
    assert len(found) == 8
    types = {r["PROJETO"]: r["tipo_projeto"] for r in found}
    assert types == {
        "Projeto A": "Compartilhado",
        "Projeto B": "Exclusivo",
        "Projeto C": "Compartilhado",
        None: "Exclusivo",
    }
    assert {r["UNIDADE_FINAL"] for r in found} == {"UNIDADE FINAL 1", "UNIDADE FINAL 2", "N/A"}
    assert "UNIDADE" not in found[0]


def test_two_names_of_one_final_unit_count_as_two(rows):
    df = rows([("P", "U1"), ("P", "U2")], "PROJETO string, UNIDADE string")
    units = rows([("U1", "CDE"), ("U2", "CDE")], "nm_unidade_padronizada string, final string")
    found = as_dicts(base.analysis_base(df, units))
    assert {(r["UNIDADE_FINAL"], r["tipo_projeto"]) for r in found} == {("CDE", "Compartilhado")}


def test_display_names(rows):
    directory = rows(
        [(" bauru ", " Escritório Bauru ", 1), ("BAURU", "Escritório / Bauru", 2)],
        "unidade string, nome_novo string, linha int",
    )
    df = rows([("BAURU",), ("UNIDADE PROJETOS E OBRAS",)], "UNIDADE_FINAL string")
    found = as_dicts(base.unit_names(df, directory, "linha"))
    assert [(r["nome_novo"], r["unit_slug"], r["no_diretorio"]) for r in found] == [
        ("Escritório / Bauru", "Escritório___Bauru", True),
        ("PROJETOS E OBRAS", "PROJETOS_E_OBRAS", False),
    ]
    assert base.unit_slice(df, " bauru ").count() == 1
