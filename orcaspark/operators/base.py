"""Categorised analysis base: standard units, project types, display names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orcaspark.functions import slug, standard_unit, strip_ws
from orcaspark.operators.rows import first_by_key, last_by_key, lookup_join, reading_order

EXCLUSIVE = "Exclusivo"
SHARED = "Compartilhado"


def unit_lookup(unit_map: DataFrame, position: str | None = None) -> DataFrame:
    """Unit map keyed by trimmed upper-case name, one row per name: the last one read.

    Without an order (``position``, or the readers' ``linha``) it is the greatest text.
    """
    position = reading_order(unit_map, position)
    key = F.upper(strip_ws(F.col("nm_unidade_padronizada")))
    keyed = unit_map.withColumn("unidade_padrao", key)
    if position:
        keyed = last_by_key(keyed, ["unidade_padrao"], position)
        return keyed.select("unidade_padrao", F.col("final").alias("unidade_final"))
    return keyed.groupBy("unidade_padrao").agg(F.max("final").alias("unidade_final"))


def project_types(pairs: DataFrame) -> DataFrame:
    """``Compartilhado`` for projects used by more than one unit, else ``Exclusivo``.

    ``pairs`` holds ``PROJETO`` and ``UNIDADE``; names are standardised first, not
    mapped, so two names of one final unit count as two.
    """
    several = F.count_distinct(standard_unit(F.col("UNIDADE"))) > 1
    return (
        pairs.filter(F.col("PROJETO").isNotNull())
        .groupBy("PROJETO")
        .agg(F.when(several, SHARED).otherwise(EXCLUSIVE).alias("tipo_projeto"))
    )


def analysis_base(
    reconciled: DataFrame,
    unit_map: DataFrame,
    pairs: DataFrame | None = None,
    position: str | None = None,
) -> DataFrame:
    """Reconciled rows with ``UNIDADE_FINAL`` and ``tipo_projeto``.

    ``pairs`` may name a cheaper source of the same (project, unit) pairs, such as
    the staged inputs of the reconciliation; by default they come from
    ``reconciled``. Both joins leave the row count as it is; neither side is
    forced to broadcast, so a large project table falls back to a sort-merge join
    in which Spark splits the partitions of a hot project.
    """
    types = project_types(reconciled if pairs is None else pairs)
    rows = reconciled.withColumn("unidade_padrao", standard_unit(F.col("UNIDADE")))
    named = (
        lookup_join(rows, unit_lookup(unit_map, position), ["unidade_padrao"])
        .withColumn("UNIDADE_FINAL", F.coalesce("unidade_final", "unidade_padrao"))
        .drop("UNIDADE", "unidade_padrao")
    )
    typed = lookup_join(named, types, ["PROJETO"])
    return typed.withColumn("tipo_projeto", F.coalesce("tipo_projeto", F.lit(EXCLUSIVE)))


def directory_lookup(directory: DataFrame, position: str | None = None) -> DataFrame:
    """Unit directory with trimmed texts, keyed by upper-case unit, one row per unit: the last one read.

    Without an order (``position``, or the readers' ``linha``) it is the smallest row.
    """
    position = reading_order(directory, position)
    texts = {c: strip_ws(F.coalesce(F.col(c), F.lit(""))) for c in directory.columns if c != position}
    clean = directory.withColumns(texts).withColumn("unidade", F.upper("unidade"))
    if position:
        return last_by_key(clean, ["unidade"], position).drop(position)
    return first_by_key(clean, ["unidade"], [F.col(c) for c in directory.columns])


def unit_names(units: DataFrame, directory: DataFrame, position: str | None = None) -> DataFrame:
    """Display name and file-safe name of each ``UNIDADE_FINAL``, sorted by display name.

    Units without a directory row show their own name without the word ``UNIDADE``.
    """
    known = directory_lookup(directory, position).select(
        F.col("unidade").alias("_unidade"), F.col("nome_novo").alias("_nome")
    )
    fallback = strip_ws(F.replace("UNIDADE_FINAL", F.lit("UNIDADE "), F.lit("")))
    return (
        units.select("UNIDADE_FINAL")
        .distinct()
        .join(known, F.upper("UNIDADE_FINAL") == F.col("_unidade"), "left")
        .select(
            "UNIDADE_FINAL",
            F.coalesce("_nome", fallback).alias("nome_novo"),
            slug(F.coalesce("_nome", fallback)).alias("unit_slug"),
            F.col("_unidade").isNotNull().alias("no_diretorio"),
        )
        .orderBy("nome_novo", "UNIDADE_FINAL")
    )


def unit_slice(base: DataFrame, unit: str) -> DataFrame:
    """Rows of one unit, ignoring case and outer blanks."""
    return base.filter(F.upper(strip_ws(F.col("UNIDADE_FINAL"))) == F.lit(unit.strip().upper()))
