"""Insert-or-update of a table by key, as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orcaspark.operators.rows import rejected


def check_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise ``ValueError`` on missing key columns, null key values or repeated keys."""
    missing = [k for k in keys if k not in source.columns]
    if missing:
        raise ValueError(f"key columns {missing} are not in the source")
    if not rejected(source, *keys).isEmpty():
        raise ValueError(f"the source has null values in the key {list(keys)}")
    repeated = source.groupBy(*keys).count().filter(F.col("count") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"the source has several rows for one key {list(keys)}")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows updated by, and extended with, the rows of ``source``.

    Rows are matched on ``keys``; target rows are never removed and null keys
    match nothing. With equal columns an update replaces the row, so the target is
    only filtered by an anti join (no shuffle of the target while the source is
    small) and the source appended. Columns only the target has survive an update
    and are null on insert.
    """
    keys = list(keys)
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    source = source.select(
        *[F.col(f.name).cast(f.dataType) for f in target.schema.fields if f.name in source.columns]
    )
    untouched = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    own = [c for c in target.columns if c not in source.columns]
    if set(source.columns) == set(keys) and own:
        fresh = source.join(target.select(*keys), keys, "left_anti")
        return target.unionByName(fresh, allowMissingColumns=True)
    if not own:
        return untouched.unionByName(source)
    updated = source.join(target.select(*keys, *own), keys, "left")
    return untouched.unionByName(updated)
