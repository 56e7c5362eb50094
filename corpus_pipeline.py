"""Corpus pipeline: from ``documents`` to token ids, stage by stage.

Each stage takes the rows its predecessor kept and its decisions take effect: toxic
documents go, one document of each group of near-duplicates stays, secrets are masked,
sources are mixed to their target weights, and what is left is encoded.

All stages take nulls in any column, empty and very long texts, ties, repeated rows, empty tables and
extra columns, which they drop. A stage's result is written before the next stage starts: what a
stage staged for itself is deleted then. Rows travel to Python in short batches from the first stage on, also
after it: a stage's result is written when its function has returned.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm import bpe, minhash, mixing, secrets, toxicity
from orcaspark.llm.common import ship, shorten_batches, table
from orcaspark.session import collecting, delete, stage, unstage

#: What stands for a secret in a text.
MASK = "[SECRET]"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Tables that the stage begun last has staged.
_staged: list[str] = []


def in_turn(function: Stage) -> Stage:
    """``function`` with this package on the executors, and without what the stage before it had staged."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _staged:
            delete(spark, _staged.pop())
        with collecting(_staged):
            return function(shorten_batches(ship(spark)), docs, sf_dir)

    return run


@in_turn
def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold of their language; learnt from ``labels``.

    A null text counts as an empty one, and so does a null language. Repeated rows are judged alike. A language
    with few labels has the threshold of all, which is 0.5 without any.
    """
    docs = docs.select(*COLUMNS)
    model = toxicity.fit(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).filter(~F.col("flagged")).select(*COLUMNS)


@in_turn
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that with the smallest id, and one row of repeated ones.

    Null and empty texts are like no other and all stay; rows with a null id take part.
    """
    return minhash.deduplicated(docs.select(*COLUMNS))


@in_turn
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by ``MASK`` and ``n_chars`` counted anew where there was one.

    Null texts stay null, empty ones empty; repeated rows are masked alike.
    """
    masked = secrets.scan(docs.select(*COLUMNS), mask=MASK)
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).select(*COLUMNS)


@in_turn
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a document comes out as often as it is taken, the last time maybe in part.

    A null source is a source, the last one; null and empty texts have no words and are never taken. Ties and
    repeated rows are ordered by a seeded hash, so reruns agree.
    """
    return mixing.mix(docs.select(*COLUMNS))


@in_turn
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the digests of the ids and of the decoded bytes.

    A null text is encoded as an empty one, to no ids; every row comes out, repeated ones as well.
    """
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.tokenize(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", keep_civil),
    ("minhash", keep_one_of_each),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Training, alignment and apportionment aren't expressible in SQL; the tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        before, docs = docs, stage(function(spark, docs, sf_dir), name)
        unstage(before)
    return STAGES[-1][1](spark, docs, sf_dir)
