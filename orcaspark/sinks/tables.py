"""Keyed table loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orcaspark.operators.keys import rebuild_corrections
from orcaspark.operators.merge import check_keys, merge_rows
from orcaspark.schemas import KEY_CORRECTIONS
from orcaspark.session import stage
from orcaspark.sources.lookup_files import read_json_map
from orcaspark.sources.versioned import CommitConflict, VersionedTable


#: Times a load is tried again after another writer was faster.
ATTEMPTS = 3


def upsert(table: VersionedTable, source: DataFrame, keys: Sequence[str]) -> int | None:
    """Insert or update by key, creating the table on first load.

    Nothing happens when the source is empty. Returns the current version. The
    source is staged first: the checks and the merge read it several times. Only files that
    hold a key of the source are rewritten. If another writer commits meanwhile, the
    load is merged into its version instead.
    """
    missing = [k for k in keys if k not in source.columns]
    if missing and not source.isEmpty():
        raise ValueError(f"key columns {missing} are not in the source")
    source = stage(source, "carga")
    if source.isEmpty():
        return table.version()
    check_keys(source, keys)
    for _ in range(ATTEMPTS):
        try:
            return table.merge(source, keys)
        except CommitConflict as conflict:
            last = conflict
    raise last


def upsert_partitions(
    path: str, source: DataFrame, keys: Sequence[str], partitions: Sequence[str]
) -> bool:
    """Upsert into a partitioned Parquet table, rewriting only the partitions touched.

    For tables too large to rewrite per load. The partition columns are key
    columns, so a row never changes partition. Spark writes the new files aside
    and swaps whole partitions when the job commits. Returns whether anything was
    written.
    """
    if not set(partitions) <= set(keys):
        raise ValueError("partition columns must be key columns")
    source = stage(source, "carga")
    if source.isEmpty():
        return False
    check_keys(source, keys)
    spark = source.sparkSession
    try:
        current = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        merged = source
    else:
        touched = source.select(*partitions).distinct()
        merged = merge_rows(
            current.join(touched, list(partitions), "left_semi"), source, keys
        )
    (
        merged.hint("rebalance", *[F.col(c) for c in partitions])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )
    return True


def save_corrections(table: VersionedTable, accepted: DataFrame) -> int | None:
    """Add or update accepted repairs, keyed by the broken key; unchanged keys are skipped."""
    columns = KEY_CORRECTIONS.fieldNames()
    changed = accepted.select(*columns).filter(F.col(columns[0]) != F.col(columns[1]))
    return upsert(table, changed, columns[:1])


def replace_corrections(table: VersionedTable, corrections: DataFrame, after: int | None = None) -> int | None:
    """Replace the whole correction table; an empty input leaves it as it is.

    ``after`` is the version the new rows take account of, see ``VersionedTable.replace``.
    """
    columns = KEY_CORRECTIONS.fieldNames()
    rows = stage(corrections.select(*[F.col(c).cast("string") for c in columns]), "correcoes")
    return table.version() if rows.isEmpty() else table.replace(rows, columns[:1], after)


def rebuild_corrections_job(table: VersionedTable, result: DataFrame, keep_others: bool = False) -> int | None:
    """Replace the corrections by those an earlier result implies; without any the table stays as it is.

    ``result`` is read for its two key columns only. With ``keep_others`` the corrections of keys
    that the result doesn't change stay. A correction that another writer saves between the start and the
    commit is not lost: the job then ends with ``CommitConflict``.
    """
    version = table.version()
    rebuilt = rebuild_corrections(result)
    if keep_others and version is not None:
        known = table.read(version).select(*rebuilt.columns)
        rebuilt = known.join(rebuilt, rebuilt.columns[:1], "left_anti").unionByName(rebuilt)
    return replace_corrections(table, rebuilt, version or 0)


def load_corrections_job(table: VersionedTable, path: str) -> int | None:
    """Replace the correction table by the entries of JSON files, see ``read_json_map``.

    Like ``rebuild_corrections_job`` it loses nothing that another writer saves meanwhile.
    """
    version = table.version()
    return replace_corrections(table, read_json_map(table.spark, path), version or 0)
