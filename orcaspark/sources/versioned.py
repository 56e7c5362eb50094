"""Parquet tables that change by versions: each load adds files and commits a list of the files that count.

A table root holds ``data/<load>`` folders, ``manifests/<load>`` (one row per file and group
of keys, with its least and greatest key) and ``commits/<number>``. A version is a commit file
that may not exist before: of two writers that started from one version one succeeds and
the other is told. Readers take the last commit, so they never see a half-written version, a
failed load leaves the table as it was, and a job may read the table it changes. A merge
rewrites the files that hold a key of the load and lists all others again.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orcaspark.operators.merge import merge_rows

logger = logging.getLogger(__name__)

#: Conditions of files that are missing or damaged.
UNREADABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE")
#: Versions that stay readable; how many leading key columns group the keys of a manifest.
KEPT, GROUPED_BY = 10, 2

FILE, ROWS, LEAST, GREATEST = "arquivo", "linhas", "menor", "maior"


class CommitConflict(RuntimeError):
    """Another writer committed the version that this load was for."""


@dataclass(frozen=True)
class Commit:
    """What a version consists of: the load that wrote its manifest, its columns and the keys of its files."""

    version: int
    load: str
    schema: StructType
    keys: list[str]


class VersionedTable:
    """A table under ``root``; ``kept`` versions stay readable after a commit, older ones are deleted."""

    def __init__(self, spark: SparkSession, root: str, kept: int = KEPT):
        self.spark = spark
        self.root = root.rstrip("/")
        self.kept = kept

    # -- files ---------------------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Committed versions that are still listed, ascending."""
        folder = self._path("commits")
        files = self._files()
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(int(n) for n in names if n.isdigit())

    def version(self) -> int | None:
        """Latest committed version, ``None`` before the first write."""
        return max(self.versions(), default=None)

    def commit(self, version: int | None = None) -> Commit | None:
        """The given commit or the latest, ``None`` if there is none."""
        version = self.version() if version is None else version
        if version is None:
            return None
        text = self.spark.read.text(f"{self.root}/commits/{version:020d}", wholetext=True).first()[0]
        found = json.loads(text)
        return Commit(version, found["load"], StructType.fromJson(found["schema"]), found["keys"])

    def _publish(self, commit: Commit) -> int:
        """Make ``commit`` the version it is numbered as, unless that exists."""
        jvm, files = self.spark.sparkContext._jvm, self._files()
        draft, place = self._path("drafts", commit.load), self._path("commits", f"{commit.version:020d}")
        content = {"load": commit.load, "schema": commit.schema.jsonValue(), "keys": commit.keys}
        stream = files.create(draft, True)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        files.mkdirs(place.getParent())
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        kind = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = getattr(kind, "NONE")
        try:
            context.rename(files.makeQualified(draft), files.makeQualified(place), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error):
                raise
            for part in ("drafts", "data", "manifests"):  # what the load wrote in vain
                files.delete(self._path(part, commit.load), True)
            raise CommitConflict(f"version {commit.version} of {self.root} was committed by another writer") from error
        self.retain(self.kept)
        return commit.version

    # -- reading -------------------------------------------------------------------------

    def manifest(self, commit: Commit) -> DataFrame:
        """Files of a version: ``arquivo``, ``linhas``, and for keyed tables the groups' least and greatest keys."""
        return self.spark.read.parquet(f"{self.root}/manifests/{commit.load}")

    def _names(self, manifest: DataFrame) -> list[str]:
        return sorted(r[FILE] for r in manifest.select(FILE).distinct().collect())

    def _scan(self, commit: Commit, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], commit.schema)
        return self.spark.read.schema(commit.schema).parquet(*[f"{self.root}/data/{n}" for n in names])

    def read(self, version: int | None = None) -> DataFrame | None:
        """Rows of the given version or the latest, ``None`` if the table does not exist."""
        commit = self.commit(version)
        return None if commit is None else self._scan(commit, self._names(self.manifest(commit)))

    # -- writing -------------------------------------------------------------------------

    def _write(self, df: DataFrame, load: str, keys: Sequence[str]) -> DataFrame:
        """Write the rows of a load, files by ranges of keys, and return their manifest rows."""
        folder = f"{self.root}/data/{load}"
        if keys:
            df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        df.write.parquet(folder)
        rows = self.spark.read.schema(df.schema).parquet(folder)
        name = F.concat(F.lit(f"{load}/"), F.col("_metadata.file_name"))
        found = [F.count("*").alias(ROWS)]
        if keys:
            found += [F.min(F.struct(*keys)).alias(LEAST), F.max(F.struct(*keys)).alias(GREATEST)]
        return rows.groupBy(name.alias(FILE), *keys[:GROUPED_BY]).agg(*found)

    def replace(self, df: DataFrame, keys: Sequence[str] = (), after: int | None = None) -> int:
        """Write ``df`` as the next version, whole; with ``keys`` later merges find the files of a key.

        ``after`` is the version that ``df`` was made from (0: none): if there is a later one by now,
        ``CommitConflict`` is raised and nothing that came in between is lost.
        """
        last = self.version() if after is None else after
        load, keys = uuid4().hex, list(keys)
        self._write(df, load, keys).write.parquet(f"{self.root}/manifests/{load}")
        return self._publish(Commit((last or 0) + 1, load, df.schema, keys))

    def merge(self, source: DataFrame, keys: Sequence[str]) -> int:
        """Update and insert by key as the next version; ``source`` has one row per key, see ``merge_rows``.

        Only files with a range that holds a key of ``source`` are read and written anew. Keys meet the
        manifest by equality of their leading columns, then by range. A table written with other
        keys is rewritten whole, once.
        """
        commit, load, keys = self.commit(), uuid4().hex, list(keys)
        if commit is None:
            return self.replace(source, keys)
        listed = self.manifest(commit)
        if commit.keys == keys:
            touched = self._names(self._touched(listed, source, keys))
        else:
            touched = self._names(listed)
        merged = merge_rows(self._scan(commit, touched), source, keys)
        manifest = self._write(merged, load, keys)
        if commit.keys == keys:
            gone = self.spark.createDataFrame([(n,) for n in touched], f"{FILE} string")
            manifest = manifest.unionByName(listed.join(gone, FILE, "left_anti"))
        manifest.write.parquet(f"{self.root}/manifests/{load}")
        return self._publish(Commit(commit.version + 1, load, commit.schema, keys))

    def _touched(self, listed: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
        """Manifest rows whose range holds a key of ``source``."""
        group = keys[:GROUPED_BY]
        asked = source.select(*[F.col(k).cast(listed.schema[LEAST].dataType[k].dataType) for k in keys])
        asked = asked.select(*group, F.struct(*keys).alias("_chave"))
        held = F.col("_chave").between(F.col(LEAST), F.col(GREATEST))
        return listed.join(asked, group).filter(held).select(FILE)

    def retain(self, kept: int) -> None:
        """Delete all but the last ``kept`` versions and the files that only they list."""
        versions, files = self.versions(), self._files()
        old = versions[: max(0, len(versions) - max(1, kept))]
        if not old:
            return
        of_old = [self.commit(v) for v in old]
        in_use = [self.commit(v) for v in versions[len(old) :]]

        def names(commits: list[Commit]) -> set[str]:
            return {n for c in commits for n in self._names(self.manifest(c))}

        used = names(in_use)
        unused = names(of_old) - used
        for commit in of_old:  # first the commits: nobody finds what is deleted after them
            files.delete(self._path("commits", f"{commit.version:020d}"), False)
        for name in unused:
            files.delete(self._path("data", name), False)
        loads = {c.load for c in of_old} | {n.split("/")[0] for n in unused}
        for load in loads - {n.split("/")[0] for n in used} - {c.load for c in in_use}:
            files.delete(self._path("data", load), True)
        for commit in of_old:
            files.delete(self._path("manifests", commit.load), True)


def snapshot(table: VersionedTable, build: Callable[[], DataFrame]) -> DataFrame:
    """Cached result of ``build``: written on first use, rebuilt if it cannot be read.

    Counting opens the footer of every file without reading columns. Where another writer
    was faster, its result is the snapshot.
    """
    try:
        current = table.read()
        if current is not None:
            current.count()
            return current
    except (PySparkException, Py4JJavaError) as error:  # other faults, such as missing rights, are the caller's
        if not any(condition in str(error) for condition in UNREADABLE):
            raise
        logger.warning("snapshot %s is unreadable and will be rebuilt: %s", table.root, error)
    try:
        table.replace(build())
    except CommitConflict:
        logger.info("snapshot %s was built by another writer", table.root)
    return table.read()
