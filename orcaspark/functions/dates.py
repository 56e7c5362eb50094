"""Date expressions and year bounds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month labels of the trend report.
MONTH_LABELS = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez"]


def year_bounds(year: int) -> tuple[date, date]:
    """First and last day of a year, for range filters that reach the scan."""
    return date(year, 1, 1), date(year, 12, 31)


def month_label(month: Column) -> Column:
    """Short month name for 1..12, null outside."""
    return F.try_element_at(F.array(*[F.lit(m) for m in MONTH_LABELS]), F.nullif(month, F.lit(0)))


def year_of(c: Column) -> Column:
    """Year of a timestamp or date text; null when it does not parse."""
    return F.year(c.try_cast("timestamp"))
