"""A third of all rows under one key: joins split it, aggregates reduce it before the shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from orcaspark.lookups import nature_names
from orcaspark.operators import enrich, keys, reconcile
from orcaspark.operators.ledger import executed_monthly
from orcaspark.schemas import KEY_CORRECTIONS
from orcaspark.session import stage, tune

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield tune(spark)
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def facts(spark, n):
    """Planned rows of ``n`` ids of which a third share one key."""
    project = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 997))
    return spark.range(0, n, 1, 16).select(
        project.alias("PROJETO"),
        F.lit("A").alias("ACAO"),
        F.lit("U").alias("UNIDADE"),
        F.lit(2025).alias("ANO"),
        (F.col("id") % 12 + 1).cast("int").alias("MES"),
        (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 100).cast("decimal(18,2)").alias("Valor_Ajustado"),
        F.sha2(F.col("id").cast("string"), 256).alias("obs"),
    )


def test_hot_key_is_split_in_the_enrichment_join(small_partitions):
    spark, n = small_partitions, 60_000
    rows = stage(keys.prepare_keys(facts(spark, n)), "facts")
    reference = rows.select(*keys.MATCH_KEYS).distinct().withColumn(
        "CODCCUSTO", F.concat(F.lit("c"), "PROJETO")
    )
    joined = enrich.enrich_planned(rows, stage(reference, "reference"))
    saved = enrich.consolidate(joined)
    total, hot = F.sum("Valor_Ajustado"), "PROJETO = 'hot'"
    assert saved.agg(total).first() == rows.agg(total).first()
    assert saved.filter(hot).agg(total).first() == rows.filter(hot).agg(total).first()
    assert saved.filter(hot).count() == 4
    execution = saved._jdf.queryExecution()
    saved.collect()
    plan = execution.executedPlan().toString().split("Initial Plan")[0]
    assert re.search(r"SortMergeJoin\(skew=true\)", plan), plan


def test_unmatched_keys_meet_the_join_once(small_partitions):
    spark, n = small_partitions, 60_000
    rows = keys.prepare_keys(facts(spark, n))
    reference = rows.filter("PROJETO = 'hot'").select(*keys.MATCH_KEYS).distinct()
    lost = keys.unmatched_keys(rows, reference)
    assert lost.count() == 997
    plan = lost._jdf.queryExecution().executedPlan().toString()
    join = plan.index("Join")
    assert plan.count("HashAggregate", join) >= 2  # partial and final below the join


def test_hot_key_is_split_in_the_table_function(small_partitions):
    """A third of the plan lies on one five-part key; no list gathers it and its join is split."""
    spark, n = small_partitions, 30_000
    hot = F.col("id") % 3 == 0
    planned = spark.range(0, n, 1, 16).select(
        F.lit(2025).alias("ANO"),
        F.when(hot, 1).otherwise(F.col("id") % 12 + 1).cast("int").alias("MES"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 997)).alias("PROJETO"),
        F.when(hot, F.concat(F.lit("a"), F.col("id") % 2)).otherwise(F.lit("a")).alias("ACAO"),
        F.lit("U").alias("UNIDADE"),
        F.lit("c").alias("CODCCUSTO"),
        F.lit("n").alias(reconcile.NATURE_CODE),
        F.sha2(F.col("id").cast("string"), 256).alias(reconcile.NATURE_TEXT),
        F.lit("P").alias("Descricao_PPA"),
        F.lit(1).cast("decimal(18,2)").alias("Valor_Ajustado"),
    )
    planned = stage(planned, "plano")
    ledger = spark.range(0, 3000, 1, 4).select(
        F.lit("2025-01-15").cast("date").alias("DATA"),
        F.when(F.col("id") < 3, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 997)).alias("PROJETO"),
        F.lit("b").alias("ACAO"), F.lit("U").alias("UNIDADE"), F.lit("c").alias("CC"), F.lit("n").alias("cdgContaNvl4"),
        F.concat(F.lit("t"), F.col("id") % 3).alias("DESCNVL4"), F.lit("DESPESAS").alias("DESCNVL1"),
        F.lit(2).cast("decimal(18,2)").alias("VALOR"),
    )
    ledger = stage(ledger, "razao")
    planned.createOrReplaceTempView("plano_quente")
    ledger.createOrReplaceTempView("razao_quente")
    reconcile.nature_table(nature_names(spark)).createOrReplaceTempView("naturezas")
    reconcile.register_reconcile_function(spark, "plano_quente", "razao_quente", "naturezas", "planejado_quente")
    text = "SELECT * FROM planejado_quente(DATE'2025-01-01', DATE'2025-12-31', 'P')"
    found = spark.sql(text)
    execution = found._jdf.queryExecution()
    got = found.groupBy("PROJETO", "MES", "ACAO").agg(F.count("*"), F.sum("Valor_Planejado"), F.sum("Valor_Executado")).collect()
    want = reconcile.reconcile(planned, executed_monthly(ledger, "2025-01-01", "2025-12-31"))
    want = want.groupBy("PROJETO", "MES", "ACAO").agg(F.count("*"), F.sum("Valor_Planejado"), F.sum("Valor_Executado")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    found.collect()
    plan = execution.executedPlan().toString().split("Initial Plan")[0]
    assert "collect_" not in plan and re.search(r"SortMergeJoin\(skew=true\)", plan), plan


def test_commitments_are_summed_before_they_repeat(spark):
    """Many commitments of one code and month repeat once on each leaf, not once each."""
    reference = spark.createDataFrame(
        [(f"1.2.{i}", "P", f"A{i}", "U", 2025) for i in range(20)], "CODCCUSTO string, PROJETO string, ACAO string, UNIDADE string, ANO int"
    )
    committed = spark.range(3000).selectExpr(
        "'1.2' AS CODCCUSTO", "2025 AS ANO", "cast(id % 3 + 1 AS int) AS MES", "cast(id AS decimal(18,2)) AS COMPROMETIDO"
    )
    fixes = spark.createDataFrame([], KEY_CORRECTIONS)
    totals = enrich.committed_totals(committed)
    assert totals.count() == 3 and enrich.enrich_committed(totals, reference).count() == 60
    got = enrich.consolidate_committed(committed, reference, fixes)
    want = enrich.consolidate(enrich.committed_flow(committed, reference, fixes))
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 60
