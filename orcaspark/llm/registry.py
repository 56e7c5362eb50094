"""Registered queries over the corpus tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from orcaspark.llm import (
    ann,
    bpe,
    html,
    licenses,
    lm,
    minhash,
    mixing,
    secrets,
    spelling,
    toxicity,
    urlrules,
    vecdedup,
    whitening,
)
from orcaspark.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]


def shipped(query: Query) -> Query:
    """``query`` with this package on the executors."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ship(spark), sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = (
        secrets.op1_secrets,
        bpe.op2_bpe,
        toxicity.op3_toxicity,
        ann.op4_neighbours,
        html.op5_html,
        mixing.op6_mixing,
        vecdedup.op7_vectors,
        urlrules.op8_urls,
        licenses.op9_licenses,
        minhash.op10_minhash,
        lm.op11_lm,
        spelling.op12_spelling,
        whitening.op13_whitening,
    )
    return {q.__name__: shipped(q) for q in found}


def oracle_sql() -> dict[str, str]:
    """SQL twins; queries without one are held against brute force by the tests."""
    return {"op12_spelling": spelling.ORACLE_SQL}
