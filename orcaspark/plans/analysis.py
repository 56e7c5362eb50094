"""Analysis base of one year, with its inputs computed once."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from orcaspark.functions.dates import year_bounds
from orcaspark.operators.base import analysis_base
from orcaspark.operators.ledger import executed_monthly
from orcaspark.operators.reconcile import plan_snapshot, reconcile, reconcile_strict
from orcaspark.session import stage_all

DEFAULT_YEAR = 2025
DEFAULT_PPA = "PPA 2025 - 2025/DEZ"


class Sides(NamedTuple):
    """Planned snapshot and executed months, both already reduced and staged."""

    planned: DataFrame
    executed: DataFrame

    def pairs(self) -> DataFrame:
        """(project, unit) pairs of both sides: those of the reconciled rows."""
        wanted = ["PROJETO", "UNIDADE"]
        return self.planned.select(*wanted).unionByName(self.executed.select(*wanted))


def both_sides(
    planned: DataFrame, ledger: DataFrame, year: int = DEFAULT_YEAR, ppa: str = DEFAULT_PPA
) -> Sides:
    """Stage the year's executed months and the plan snapshot.

    Each is read three times afterwards (key spine, join, project types), so the
    ledger is scanned once instead of three times.
    """
    executed = executed_monthly(ledger, *year_bounds(year))
    return Sides(*stage_all({"planejado": plan_snapshot(planned, ppa), "executado": executed}))


def planned_vs_executed(sides: Sides, names: DataFrame | None = None, strict: bool = False):
    """Reconciliation of both sides; ``strict`` conserves the amounts."""
    combine = reconcile_strict if strict else reconcile
    return combine(sides.planned, sides.executed, names)


def build_base(
    sides: Sides,
    unit_map: DataFrame,
    names: DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Reconciled and categorised rows."""
    return analysis_base(planned_vs_executed(sides, names, strict), unit_map, sides.pairs())
