"""What the corpus operators share: reading, shipping code, Arrow helpers."""

from __future__ import annotations

import ctypes
import io
import pickle
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from pathlib import Path

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.session import staging_root

PACKAGE = Path(__file__).resolve().parent.parent

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, by an archive in the shared folder."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = io.BytesIO()
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(PACKAGE.rglob("*.py")):
                out.write(path, path.relative_to(PACKAGE.parent))
        place = context._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/{PACKAGE.name}.zip")
        stream = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place, True)
        stream.write(bytearray(archive.getvalue()))
        stream.close()
        context.addPyFile(place.toString())
        _shipped.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that are Python objects at a time; Arrow batches are cut to it.
ROWS = 1024


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shorten_batches(spark: SparkSession, rows: int = ROWS) -> SparkSession:
    """From now on the session sends Python at most ``rows`` rows at a time: a batch of texts is in memory on both sides."""
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))
    return spark


@contextmanager
def short_batches(spark: SparkSession, rows: int = ROWS) -> Iterator[None]:
    """``shorten_batches`` for the jobs run within."""
    before = spark.conf.get(BATCH_ROWS)
    shorten_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def release() -> None:
    """Give back to the machine what this process has freed; Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


Convert = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def releasing(convert: Convert) -> Convert:
    """``convert`` between two calls of ``release``: a worker outlives its task and waits for those of other stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from convert(batches)
        release()

    return run


def per_batch(df: DataFrame, convert: Callable[[pa.RecordBatch], dict], schema: str, rows: int = ROWS) -> DataFrame:
    """Map batches of at most ``rows`` rows through ``convert``, which returns the columns of ``schema`` by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), rows):
                yield pa.RecordBatch.from_pydict(convert(batch.slice(begin, rows)))

    return df.mapInArrow(releasing(run), schema)


def texts(column: pa.Array) -> list[str]:
    """Python strings of a text column; null counts as empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def plain_names(df: DataFrame, needed: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with every column but the needed ones renamed, and a function that gives the names back.

    So columns an operator adds can't clash with extra ones of its input.
    """
    names = {c: c if c in needed else f"extra_{i}" for i, c in enumerate(df.columns)}

    def back(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(f"`{new}`").alias(old) for old, new in names.items()])

    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()]), back


#: Partial results that one task merges.
FAN_IN = 256


def gathered(
    rows: DataFrame, fold: Callable[[Iterator[pa.RecordBatch]], object], merge: Callable[[object, object], object]
) -> object | None:
    """Every partition folded to one value and the values merged: in tasks of ``FAN_IN`` values, twice, then here.

    A value is of fixed size however many rows it covers; ``fold`` gives ``None`` for no rows, as
    ``gathered`` does if there are none at all. Values are merged in the order of the partitions, so a
    rerun rounds alike.
    """

    def packed(place: int, value: object) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"place": pa.array([place], pa.int64()), "value": [pickle.dumps(value)]})

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = fold(batch for batch in batches if len(batch))
        if value is not None:
            yield packed(TaskContext.get().partitionId(), value)

    def merged(found: list[tuple[int, bytes]]) -> object | None:
        whole = None
        for _, value in sorted(found):
            part = pickle.loads(value)
            whole = part if whole is None else merge(whole, part)
        return whole

    def together(group: pa.Table) -> pa.Table:
        found = list(zip(group["place"].to_pylist(), group["value"].to_pylist(), strict=True))
        return pa.Table.from_batches([packed(min(found)[0] // FAN_IN, merged(found))])

    parts = rows.mapInArrow(within, "place bigint, value binary")
    for _ in range(2):
        parts = parts.groupBy(F.floor(F.col("place") / FAN_IN)).applyInArrow(together, "place bigint, value binary")
    return merged([(r["place"], bytes(r["value"])) for r in parts.collect()])


def batch_fold(
    measure: Callable[[pa.RecordBatch], object], merge: Callable[[object, object], object]
) -> Callable[[Iterator[pa.RecordBatch]], object]:
    """Fold for ``gathered`` that measures each batch and merges the measures."""

    def fold(batches: Iterator[pa.RecordBatch]) -> object | None:
        whole = None
        for batch in batches:
            part = measure(batch)
            whole = part if whole is None else merge(whole, part)
        return whole

    return fold
