"""Number expressions: amounts, coercion, guarded ratios, report texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

AMOUNT = DecimalType(18, 2)
AMOUNT_SUM = DecimalType(28, 2)


def money(c: Column) -> Column:
    """Amount with two decimals; text, NaN or overflow that is no amount becomes null."""
    return c.try_cast(AMOUNT)


def coerce_number(c: Column) -> Column:
    """Double, or null when the value is not a number."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def coerce_int(c: Column) -> Column:
    """Integer, or null; ``'2025.0'`` and ``' 2025 '`` both read as 2025."""
    return coerce_number(c).try_cast("int")


def sum_or_zero(c: Column) -> Column:
    """Sum that is zero, not null, over a group without values."""
    return F.coalesce(F.sum(c), F.lit(0)).cast(AMOUNT_SUM)


def guarded_percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as double, 0 when the denominator is not positive."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
    return F.when(whole > 0, ratio).otherwise(F.lit(0.0))


def percent_text(c: Column) -> Column:
    """One decimal and a percent sign, no thousands separator."""
    return F.concat(F.replace(F.format_number(c, 1), F.lit(","), F.lit("")), F.lit("%"))


def brl_text(c: Column) -> Column:
    """Short currency text: ``R$ 0``, ``R$ 1,234.50`` below a thousand, then ``k`` and ``M``."""
    v = c.cast("double")

    def scaled(divisor: float, digits: int, suffix: str) -> Column:
        number = F.replace(F.format_number(v / F.lit(divisor), digits), F.lit(","), F.lit(""))
        return F.concat(F.lit("R$ "), number, F.lit(suffix))

    return (
        F.when(v.isNull() | F.isnan(v) | (v == 0), F.lit("R$ 0"))
        .when(F.abs(v) >= 1e6, scaled(1e6, 2, " M"))
        .when(F.abs(v) >= 1e3, scaled(1e3, 1, " k"))
        .otherwise(F.concat(F.lit("R$ "), F.format_number(v, 2)))
    )
