"""Every registered query against its SQL twin, and the shape of the plans."""

import re

import pytest
from conftest import SF

import __spark_entry__ as contract
from oracle import sql
from oracle.compare import connect, differences
from orcaspark.operators.ledger import supplier_month
from orcaspark.plans import registry
from orcaspark.schemas import LEDGER

QUERIES, TWINS = registry.queries(), sql.statements()
WITHOUT_TWIN = {"unit_json"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def final_plan(df):
    execution = df._jdf.queryExecution()
    df.collect()
    return execution.executedPlan().toString().split("Initial Plan")[0]


def test_names():
    assert set(QUERIES) - set(TWINS) == WITHOUT_TWIN and set(TWINS) <= set(QUERIES)


def test_contract_holds_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(TWINS) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "Valor_Planejado" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.toPandas()
    assert len(got)
    if name in TWINS:
        assert differences(df, got, duck, TWINS[name]) == ""


@pytest.mark.parametrize("name", ["suggest_corrections", "reconcile", "enrich_committed", "top_suppliers"])
def test_no_cross_joins(spark, name):
    plan = final_plan(QUERIES[name](spark, SF))
    assert not re.search("CartesianProduct|NestedLoop", plan)


def formatted(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_date_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "ledger")
    spark.createDataFrame([], LEDGER).write.parquet(path)
    plan = formatted(spark, supplier_month(spark.read.parquet(path), 2025))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "GreaterThanOrEqual(DATA,2025-01-01)" in pushed
    assert "LessThanOrEqual(DATA,2025-12-31)" in pushed
    assert "StringStartsWith(DESCNVL1,DESP)" in pushed
    read = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert re.findall(r"(\w+):", read) == ["DATA", "CC", "DESCNVL1", "FORNECEDOR", "VALOR"]


@pytest.mark.parametrize("name", ["committed_items", "reconcile_function"])
def test_year_reaches_the_scan_of_orders(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "o_orderdate" in line]
    assert scans and all("GreaterThanOrEqual(o_orderdate,1997" in s for s in scans)


def test_one_scan_feeds_both_branches_of_a_report(spark):
    plan = final_plan(QUERIES["treemap"](spark, SF))
    assert "ReusedExchange" in plan


def test_no_python_workers(spark):
    for name in ("reconcile", "treemap", "suggest_corrections", "unit_json"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas", plan), name
