"""Row-set helpers: required columns, one row per key, top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "input") -> DataFrame:
    """Raise ``KeyError`` naming the missing columns, else return ``df``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{what} lacks the required columns {missing}")
    return df


def top_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None
) -> DataFrame:
    """First ``k`` rows of each group in the given order; ``rank`` keeps the position.

    Spark limits each group to ``k`` rows per input partition before the shuffle,
    so a group holding most of the rows never travels whole.
    """
    position = rank or "_posicao"
    ranked = df.withColumn(position, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    kept = ranked.filter(F.col(position) <= k)
    return kept if rank else kept.drop(position)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return top_rows(df, keys, order, 1)


def last_by_key(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """One row per key: the one read last, ``position`` being the reading order."""
    return top_rows(df, keys, [F.col(position).desc()], 1)


def lookup_join(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join to a lookup grouped by the join keys (one or a few rows per key).

    A small lookup is broadcast by its size. Beyond that a key may hold a large part
    of the facts, and Spark splits such a partition only where both sides reach the
    join straight from a shuffle. The lookup was grouped by the same keys, which
    Spark would take for the join's partitioning; the hash as one more join key
    gives both sides a shuffle made for the join, and a later grouping its own.
    """
    mark = F.xxhash64(*[F.col(k).cast("string") for k in keys])
    joined = facts.withColumn("_marca", mark).join(
        lookup.withColumn("_marca", mark), [*keys, "_marca"], how
    )
    return joined.drop("_marca")


#: Column that readers add: the place of a row in its file.
READING_ORDER = "linha"


def reading_order(df: DataFrame, position: str | None = None) -> str | None:
    """The column that tells which of two equal keys was read last: the given one, or the readers' own."""
    return position or (READING_ORDER if READING_ORDER in df.columns else None)


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose key columns are all present (groupings ignore missing keys)."""
    return df.na.drop(subset=list(columns))


def rejected(df: DataFrame, *columns: str) -> DataFrame:
    """The rows ``not_null`` leaves out, for review."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return df.filter(missing)
