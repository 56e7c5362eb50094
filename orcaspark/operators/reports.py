"""Report rows for every unit in one pass.

Each function groups by ``UNIDADE_FINAL`` (and project type where the reports are
drawn per type), so no driver loop over units is needed. All measures are sums,
so the functions accept the analysis base or, cheaper when several reports are
made, its ``report_cube``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orcaspark.functions import brl_text, guarded_percent, percent_text, sum_or_zero
from orcaspark.functions.dates import MONTH_LABELS
from orcaspark.operators.base import EXCLUSIVE, SHARED
from orcaspark.operators.rows import not_null, top_rows

UNIT = "UNIDADE_FINAL"
TYPE = "tipo_projeto"
PROJECT = "PROJETO"
ACTION = "ACAO"
NATURE = "NATUREZA_FINAL"
PLANNED = "Valor_Planejado"
EXECUTED = "Valor_Executado"
CUBE = [UNIT, TYPE, PROJECT, ACTION, NATURE, "MES"]


def of_type(df: DataFrame, project_type: str) -> DataFrame:
    """Rows of exclusive or of shared projects."""
    return df.filter(F.col(TYPE) == project_type)


def report_cube(base: DataFrame) -> DataFrame:
    """Base summed to the finest grain the reports use.

    ``MES_PLANEJADO`` and ``MES_EXECUTADO`` hold the month where a single row has a
    positive amount, which the sums alone would not show.
    """
    return base.groupBy(*CUBE).agg(
        sum_or_zero(F.col(PLANNED)).alias(PLANNED),
        sum_or_zero(F.col(EXECUTED)).alias(EXECUTED),
        F.min(_month_with(base, PLANNED)).alias("MES_PLANEJADO"),
        F.min(_month_with(base, EXECUTED)).alias("MES_EXECUTADO"),
    )


def _month_with(df: DataFrame, measure: str) -> Column:
    known = {PLANNED: "MES_PLANEJADO", EXECUTED: "MES_EXECUTADO"}[measure]
    if known in df.columns:
        return F.col(known)
    return F.when(F.col(measure) > 0, F.col("MES"))


def _totals(df: DataFrame, *by: str) -> DataFrame:
    return (
        not_null(df, *by)
        .groupBy(*by)
        .agg(
            sum_or_zero(F.col(PLANNED)).alias(PLANNED),
            sum_or_zero(F.col(EXECUTED)).alias(EXECUTED),
        )
    )


def _in_order(rank: str, text: Column) -> Column:
    """Array of texts sorted by rank; callers bound the group to the top rows first."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), text.alias("t"))))
    return F.transform(pairs, lambda p: p["t"])


def kpi(df: DataFrame) -> DataFrame:
    """Planned and executed totals and execution percentage: all, exclusive, shared projects."""

    def only(measure: str, project_type: str | None) -> Column:
        value = F.col(measure)
        return sum_or_zero(value if project_type is None else F.when(F.col(TYPE) == project_type, value))

    blocks = {"total": None, "exclusivo": EXCLUSIVE, "compartilhado": SHARED}
    sums = []
    for name, project_type in blocks.items():
        sums.append(only(PLANNED, project_type).alias(f"{name}_planejado"))
        sums.append(only(EXECUTED, project_type).alias(f"{name}_executado"))
    totals = not_null(df, UNIT).groupBy(UNIT).agg(*sums)
    return totals.withColumns(
        {
            f"{name}_perc": guarded_percent(F.col(f"{name}_executado"), F.col(f"{name}_planejado"))
            for name in blocks
        }
    )


def kpi_text(df: DataFrame, names: DataFrame) -> DataFrame:
    """KPI texts per unit under its display name."""

    def values(name: str) -> Column:
        return F.concat(
            brl_text(F.col(f"{name}_executado")), F.lit(" de "), brl_text(F.col(f"{name}_planejado"))
        )

    texts = []
    for name in ("total", "exclusivo", "compartilhado"):
        texts.append(percent_text(F.col(f"{name}_perc")).alias(f"{name}_perc"))
        texts.append(values(name).alias(f"{name}_valores"))
    shown = names.select(UNIT, "nome_novo")
    return kpi(df).join(shown, UNIT, "left").select(UNIT, "nome_novo", *texts)


def trend(df: DataFrame) -> DataFrame:
    """Executed per month 1..12 for each unit: exclusive, shared, total; empty months are 0.

    The months are columns of one aggregate that are turned into rows afterwards,
    so neither a month table nor a join is needed.
    """

    def month_sum(month: int, project_type: str) -> Column:
        wanted = (F.col("MES") == month) & (F.col(TYPE) == project_type)
        return sum_or_zero(F.when(wanted, F.col(EXECUTED)))

    sums = []
    for month in range(1, 13):
        sums.append(month_sum(month, EXCLUSIVE).alias(f"e{month}"))
        sums.append(month_sum(month, SHARED).alias(f"c{month}"))
    wide = not_null(df, UNIT).groupBy(UNIT).agg(*sums)
    months = F.array(
        *[
            F.struct(
                F.lit(month).alias("MES"),
                F.lit(MONTH_LABELS[month - 1]).alias("rotulo"),
                F.col(f"e{month}").alias("exclusivo"),
                F.col(f"c{month}").alias("compartilhado"),
                (F.col(f"e{month}") + F.col(f"c{month}")).alias("total"),
            )
            for month in range(1, 13)
        ]
    )
    return wide.select(UNIT, F.inline(months))


def _spend_cells(df: DataFrame) -> DataFrame:
    """Positive executed amount per unit, type, nature and project."""
    cells = _totals(df, UNIT, TYPE, NATURE, PROJECT)
    return cells.filter(F.col(EXECUTED) > 0)


def treemap_detail(df: DataFrame, k: int = 3) -> DataFrame:
    """Top projects by executed amount in each nature of a unit and project type."""
    cells = _spend_cells(df).drop(PLANNED)
    order = [F.col(EXECUTED).desc(), F.col(PROJECT)]
    return top_rows(cells, [UNIT, TYPE, NATURE], order, k, rank="posicao")


def treemap(df: DataFrame, k: int = 3) -> DataFrame:
    """Executed amount per nature with its top projects as one text."""
    by = [UNIT, TYPE, NATURE]
    totals = _spend_cells(df).groupBy(*by).agg(F.sum(EXECUTED).cast("decimal(28,2)").alias(EXECUTED))
    line = F.concat(F.lit("- "), PROJECT, F.lit(" ("), brl_text(F.col(EXECUTED)), F.lit(")"))
    details = (
        treemap_detail(df, k)
        .groupBy(*by)
        .agg(F.array_join(_in_order("posicao", line), "<br>").alias("projetos"))
    )
    return totals.join(details, by, "left").withColumn("projetos", F.coalesce("projetos", F.lit("")))


def idle_budget(df: DataFrame, k: int = 7) -> DataFrame:
    """The ``k`` largest positive unspent balances of each unit, split by project type."""
    balance = F.col(PLANNED) - F.col(EXECUTED)
    projects = (
        _totals(df, UNIT, PROJECT, TYPE)
        .withColumn("saldo", balance.cast("decimal(28,2)"))
        .filter(F.col("saldo") > 0)
    )
    order = [F.col("saldo").desc(), F.col(PROJECT), F.col(TYPE)]
    return top_rows(projects, [UNIT], order, k, rank="posicao").select(
        UNIT,
        "posicao",
        PROJECT,
        TYPE,
        *[
            F.when(F.col(TYPE) == t, F.col("saldo")).otherwise(F.lit(0)).cast("decimal(28,2)").alias(c)
            for t, c in ((EXCLUSIVE, "exclusivo"), (SHARED, "compartilhado"))
        ],
    )


def idle_budget_detail(df: DataFrame, k: int = 7, actions: int = 3) -> DataFrame:
    """For each project of ``idle_budget``, its actions with the largest positive balance."""
    listed = idle_budget(df, k).select(UNIT, PROJECT)
    cells = (
        _totals(df, UNIT, PROJECT, ACTION)
        .withColumn("saldo", (F.col(PLANNED) - F.col(EXECUTED)).cast("decimal(28,2)"))
        .filter(F.col("saldo") > 0)
        .drop(PLANNED, EXECUTED)
        .join(listed, [UNIT, PROJECT], "left_semi")
    )
    order = [F.col("saldo").desc(), F.col(ACTION)]
    return top_rows(cells, [UNIT, PROJECT], order, actions, rank="posicao")


def idle_budget_report(df: DataFrame, k: int = 7, actions: int = 3) -> DataFrame:
    """``idle_budget`` with the action texts of each project as an array."""
    line = F.concat(F.lit("- "), ACTION, F.lit(": "), brl_text(F.col("saldo")))
    details = (
        idle_budget_detail(df, k, actions)
        .groupBy(UNIT, PROJECT)
        .agg(_in_order("posicao", line).alias("detalhes"))
    )
    empty = F.array().cast("array<string>")
    return (
        idle_budget(df, k)
        .join(details, [UNIT, PROJECT], "left")
        .withColumn("detalhes", F.coalesce("detalhes", empty))
    )


def _unplanned_cells(df: DataFrame) -> DataFrame:
    cells = _totals(df, UNIT, TYPE, NATURE, PROJECT)
    return cells.filter((F.col(PLANNED) <= 0) & (F.col(EXECUTED) > 0)).drop(PLANNED)


def unplanned_detail(df: DataFrame, k: int = 3) -> DataFrame:
    """Top projects spending without a plan in each nature of a unit and project type."""
    order = [F.col(EXECUTED).desc(), F.col(PROJECT)]
    return top_rows(_unplanned_cells(df), [UNIT, TYPE, NATURE], order, k, rank="posicao")


def unplanned(df: DataFrame, k: int = 3) -> DataFrame:
    """Spend without a plan per nature, largest first, with its top projects as an array."""
    by = [UNIT, TYPE, NATURE]
    totals = (
        _unplanned_cells(df)
        .groupBy(*by)
        .agg(F.sum(EXECUTED).cast("decimal(28,2)").alias(EXECUTED))
    )
    line = F.concat(F.lit("- "), PROJECT, F.lit(": "), brl_text(F.col(EXECUTED)))
    details = (
        unplanned_detail(df, k).groupBy(*by).agg(_in_order("posicao", line).alias("projetos"))
    )
    alert = F.when(F.col(TYPE) == EXCLUSIVE, F.lit("perigo")).otherwise(F.lit("aviso"))
    return (
        totals.join(details, by, "left")
        .withColumn("alerta", alert)
        .orderBy(UNIT, TYPE, F.col(EXECUTED).desc(), NATURE)
    )


def _execution_cells(df: DataFrame, project_type: str) -> DataFrame:
    cells = _totals(of_type(df, project_type), UNIT, PROJECT, NATURE)
    return cells.filter(F.col(PLANNED) > 0)


def sunburst(df: DataFrame, project_type: str = EXCLUSIVE) -> DataFrame:
    """Planned value and execution percentage per project and per nature inside it.

    Natures have their project as parent, projects have an empty parent; a
    project counts only its natures with a positive plan.
    """
    cells = _execution_cells(df, project_type)
    levels = cells.groupingSets(
        [[UNIT, PROJECT, NATURE], [UNIT, PROJECT]], UNIT, PROJECT, NATURE
    ).agg(
        F.sum(PLANNED).cast("decimal(28,2)").alias("valor"),
        F.sum(EXECUTED).cast("decimal(28,2)").alias(EXECUTED),
        F.grouping(NATURE).alias("nivel"),
    )
    whole = F.col("nivel") == 1
    return levels.select(
        UNIT,
        F.when(whole, F.col(PROJECT)).otherwise(F.col(NATURE)).alias("rotulo"),
        F.when(whole, F.lit("")).otherwise(F.col(PROJECT)).alias("pai"),
        "valor",
        guarded_percent(F.col(EXECUTED), F.col("valor")).alias("perc_exec"),
    )


def heatmap(df: DataFrame, project_type: str = EXCLUSIVE) -> DataFrame:
    """Execution percentage of each project and nature with a positive plan (long form)."""
    cells = _execution_cells(df, project_type)
    return cells.select(
        UNIT,
        PROJECT,
        NATURE,
        guarded_percent(F.col(EXECUTED), F.col(PLANNED)).alias("perc_exec"),
    )


#: Natures that become columns without being listed, at most.
MOST_COLUMNS = 500


def heatmap_pivot(
    df: DataFrame, natures: Sequence[str] | None = None, project_type: str = EXCLUSIVE
) -> DataFrame:
    """``heatmap`` with one column per nature; cells without a plan stay null.

    ``natures`` fixes the columns and must name every nature that has a cell, else
    ``ValueError`` tells the others; without it the columns are those of the data, by name.
    """
    cells = heatmap(df, project_type)
    of_cells = cells.select(NATURE).distinct()
    if natures is not None:
        of_cells = of_cells.filter(~F.col(NATURE).isin(list(natures)))
    found = sorted(r[0] for r in of_cells.limit(MOST_COLUMNS + 1).collect())
    if natures is None and len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} natures: name those that are to be columns")
    unlisted = found if natures is not None else []
    if unlisted:
        raise ValueError(f"natures without a column: {unlisted}")
    columns = found if natures is None else list(natures)
    return cells.groupBy(UNIT, PROJECT).pivot(NATURE, columns).agg(F.avg("perc_exec"))


def inertia(df: DataFrame, project_type: str = EXCLUSIVE) -> DataFrame:
    """Months from the first planned to the first executed month, where spending came late.

    Groups without one of the two months (month 0 counts as none) are left out.
    """
    by = [UNIT, PROJECT, ACTION, NATURE]
    rows = not_null(of_type(df, project_type), *by)
    first = rows.groupBy(*by).agg(
        F.nullif(F.min(_month_with(df, PLANNED)), F.lit(0)).alias("mes_planejado"),
        F.nullif(F.min(_month_with(df, EXECUTED)), F.lit(0)).alias("mes_executado"),
    )
    delay = F.col("mes_executado") - F.col("mes_planejado")
    return first.withColumn("inercia_meses", delay).filter(F.col("inercia_meses") > 0)


def inertia_worst(df: DataFrame, project_type: str = EXCLUSIVE) -> DataFrame:
    """The longest delay of each nature in a unit, longest first."""
    order = [F.col("inercia_meses").desc(), F.col(PROJECT), F.col(ACTION)]
    worst = top_rows(inertia(df, project_type), [UNIT, NATURE], order, 1)
    return worst.orderBy(UNIT, F.col("inercia_meses").desc(), NATURE)


def nested_top(df: DataFrame, natures: int = 5, projects: int = 3) -> DataFrame:
    """Top natures of each unit's exclusive projects and the top projects inside each."""
    cells = _totals(of_type(df, EXCLUSIVE), UNIT, NATURE, PROJECT).drop(PLANNED)
    cells = cells.filter(F.col(EXECUTED) > 0)
    totals = cells.groupBy(UNIT, NATURE).agg(
        F.sum(EXECUTED).cast("decimal(28,2)").alias("total_natureza")
    )
    best = top_rows(
        totals, [UNIT], [F.col("total_natureza").desc(), F.col(NATURE)], natures, "posicao_natureza"
    )
    # Both cuts only depend on their own order, so the projects are cut first.
    inner = top_rows(
        cells,
        [UNIT, NATURE],
        [F.col(EXECUTED).desc(), F.col(PROJECT)],
        projects,
        "posicao_projeto",
    )
    return inner.join(best, [UNIT, NATURE]).select(
        UNIT,
        "posicao_natureza",
        NATURE,
        "total_natureza",
        "posicao_projeto",
        PROJECT,
        EXECUTED,
        brl_text(F.col(EXECUTED)).alias("texto"),
    )
