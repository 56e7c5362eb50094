"""Session settings and shared staging."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from uuid import uuid4
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split in a join even if the next grouping then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def with_settings(builder: SparkSession.Builder, **extra: str) -> SparkSession.Builder:
    """Add the settings the operators are planned for; keywords override them."""
    for name, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(name, value)
    return builder


def tune(spark: SparkSession) -> SparkSession:
    """Turn on skew splitting in a session that was not built by ``with_settings``."""
    name = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    if spark.conf.get(name) != "true":
        spark.conf.set(name, "true")
    return spark


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables of this application.

    It lies in the folder ``spark.checkpoint.dir`` names, or beside the tables of
    the session's own warehouse where that is unset: both are storage that the
    session declares as shared, never a temporary folder of one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/stages-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the staging folder."""
    return f"{staging_root(spark)}/{label}-{uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Delete every table this application has staged; results read from them end with it."""
    delete(spark, staging_root(spark))


#: Paths staged in the scope that is open, and where each staged table lies.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)
_places: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """A scope whose staged tables are deleted at its end, also if it fails.

    What is to outlive the scope is written to a place of its own before; scopes can be nested, and a
    table belongs to the innermost one open when it is staged.
    """
    made: list[str] = []
    before = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(before)
        for path in made:
            delete(spark, path)


@contextmanager
def collecting(made: list[str]) -> Iterator[None]:
    """A scope that lists the paths of its staged tables in ``made`` and leaves their deletion to the caller."""
    before = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Used where one result feeds several branches: they then read a columnar
    table (pruned, with real sizes for join planning) and a lost executor costs
    a re-read, not a re-run of everything upstream. The table goes with the ``staging`` scope, by
    ``unstage``, or with ``release``.
    """
    path = scratch(df.sparkSession, label)
    if _scope.get() is not None:
        _scope.get().append(path)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    _places[staged] = path
    return staged


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more; other frames are left alone."""
    for df in frames:
        path = _places.pop(df, None)
        if path is not None:
            delete(df.sparkSession, path)


def stage_all(frames: dict[str, DataFrame]) -> list[DataFrame]:
    """Stage several independent results; their jobs share the executors."""
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        jobs = [pool.submit(copy_context().run, stage, df, label) for label, df in frames.items()]
        return [job.result() for job in jobs]
