import json
import os
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from orcaspark import schemas
from orcaspark.operators.merge import check_keys, merge_rows
from orcaspark.operators.rows import last_by_key
from orcaspark.sinks import extracts, tables
from orcaspark.sources import lookup_files, sql_files
from orcaspark.sources import tables as readers
from orcaspark.session import stage, stage_all, staging, unstage
from orcaspark.sources.versioned import CommitConflict, VersionedTable, snapshot

ROW = "k string, v int"


def content(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_merge_updates_inserts_and_never_deletes(rows):
    target = rows([("a", 1), ("b", 2), (None, 3)], ROW)
    merged = merge_rows(target, rows([("b", 20), ("c", 30)], ROW), ["k"])
    assert content(merged, "k", "v") == sorted([("a", 1), ("b", 20), ("c", 30), (None, 3)], key=str)


def test_merge_keeps_columns_only_the_target_has(rows):
    target = rows([("a", 1, "x"), ("b", 2, "y")], "k string, v int, own string")
    merged = merge_rows(target, rows([("b", 20), ("c", 30)], ROW), ["k"])
    assert content(merged, "k", "v", "own") == [("a", 1, "x"), ("b", 20, "y"), ("c", 30, None)]
    only_keys = merge_rows(target, rows([("b",), ("c",)], "k string"), ["k"])
    assert content(only_keys, "k", "v", "own") == [("a", 1, "x"), ("b", 2, "y"), ("c", None, None)]
    with pytest.raises(ValueError, match="w"):
        merge_rows(target, rows([("a", 1)], "k string, w int"), ["k"])


def test_source_keys_are_checked(rows):
    check_keys(rows([("a", 1), ("b", 1)], ROW), ["k"])
    for bad in ([("a", 1), ("a", 2)], [(None, 1)]):
        with pytest.raises(ValueError):
            check_keys(rows(bad, ROW), ["k"])
    with pytest.raises(ValueError, match="missing"):
        check_keys(rows([("a", 1)], ROW), ["missing"])


def test_upsert_creates_updates_and_is_idempotent(spark, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    assert tables.upsert(table, rows([], ROW), ["k"]) is None
    assert tables.upsert(table, rows([("a", 1), ("b", 2)], ROW), ["k"]) == 1
    change = rows([("b", 20), ("c", 30)], ROW)
    tables.upsert(table, change, ["k"])
    assert tables.upsert(table, change, ["k"]) == 3
    assert content(table.read(), "k", "v") == [("a", 1), ("b", 20), ("c", 30)]
    assert tables.upsert(table, rows([], ROW), ["k"]) == 3
    with pytest.raises(ValueError):
        tables.upsert(table, rows([("a", 1), ("a", 2)], ROW), ["k"])
    assert table.version() == 3


def listed(table):
    return set(table._names(table.manifest(table.commit())))


def ranges(spark, count, months=12):
    """Rows of ``count`` keys a month, in files of a month or less."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return spark.range(count * months).select(
        F.lit(2025).alias("ANO"), (F.col("id") % months + 1).cast("int").alias("MES"),
        F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"),
    )


def test_a_load_rewrites_only_files_that_hold_its_keys(spark, rows, tmp_path):
    table, keys = VersionedTable(spark, str(tmp_path / "t")), ["ANO", "MES", "k"]
    try:
        first = ranges(spark, 50)
        tables.upsert(table, first, keys)
        before = listed(table)
        assert len(before) >= 4
        change = rows([(2025, 3, "k2", -1), (2025, 3, "new", -2), (2026, 1, "k0", -3)], first.schema)
        assert tables.upsert(table, change, keys) == 2
        after = listed(table)
        assert len(before & after) >= len(before) - 2 and len(after - before) >= 1
        want = merge_rows(first, change, keys)
        assert table.read().exceptAll(want).isEmpty() and table.read().count() == want.count() == 602
        assert table.read(1).exceptAll(first).isEmpty() and table.read(1).count() == 600
        stored = table.manifest(table.commit()).agg(F.sum("linhas")).first()[0]
        assert stored == 602
        only_new = rows([(2030, 1, "x", 1)], first.schema)
        tables.upsert(table, only_new, keys)
        assert after < listed(table)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_table_of_other_keys_is_rewritten_once(spark, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(rows([("a", 1), ("b", 2)], ROW))
    assert table.commit().keys == []
    tables.upsert(table, rows([("b", 3)], ROW), ["k"])
    assert table.commit().keys == ["k"] and content(table.read(), "k", "v") == [("a", 1), ("b", 3)]


def test_two_writers_cannot_share_a_version(spark, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(rows([("a", 1)], ROW), ["k"])
    slow = VersionedTable(spark, table.root)
    start = slow.commit()
    slow.commit = lambda version=None: start  # it read the table before the other writer's load
    table.merge(rows([("b", 2)], ROW), ["k"])
    with pytest.raises(CommitConflict):
        slow.merge(rows([("c", 3)], ROW), ["k"])
    assert table.version() == 2 and content(table.read(), "k", "v") == [("a", 1), ("b", 2)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2  # the loser's files are gone
    del slow.commit
    calls = []

    def conflict_once(source, keys, merge=slow.merge):
        calls.append(1)
        if len(calls) == 1:
            raise CommitConflict("first")
        return merge(source, keys)

    slow.merge = conflict_once
    assert tables.upsert(slow, rows([("c", 3)], ROW), ["k"]) == 3
    assert content(table.read(), "k", "v") == [("a", 1), ("b", 2), ("c", 3)]


def test_old_versions_are_deleted_and_their_shared_files_stay(spark, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), kept=2)
    for number in range(5):
        tables.upsert(table, rows([(f"k{number}", number)], ROW), ["k"])
    assert table.versions() == [4, 5] and table.version() == 5
    assert content(table.read(), "k", "v") == [(f"k{n}", n) for n in range(5)]
    assert table.read(4).count() == 4
    assert len(list((tmp_path / "t" / "manifests").iterdir())) == 2
    table.replace(rows([("z", 1)], ROW))
    table.replace(rows([("z", 2)], ROW))
    loads = list((tmp_path / "t" / "data").iterdir())
    assert len(loads) == 2 and content(table.read(), "k", "v") == [("z", 2)]


def test_empty_versions_have_columns(spark, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(rows([], ROW))
    assert table.read().columns == ["k", "v"] and table.read().count() == 0
    tables.upsert(table, rows([("a", 1)], ROW), ["k"])
    assert content(table.read(), "k", "v") == [("a", 1)]


def test_staged_tables_go_with_their_scope(spark, rows):
    kept = stage(rows([("a", 1)], ROW), "kept")
    with staging(spark):
        inner = stage(rows([("b", 2)], ROW), "inner")
        both = stage_all({"x": inner, "y": kept})
        assert [df.count() for df in both] == [1, 1]
        paths = [df.inputFiles()[0] for df in [inner, *both]]
    assert not any(os.path.exists(p.removeprefix("file://")) for p in paths)
    place = kept.inputFiles()[0].removeprefix("file://")
    assert kept.count() == 1 and os.path.exists(place)
    unstage(kept, rows([("c", 3)], ROW))
    assert not os.path.exists(place)


def test_partitioned_upsert_rewrites_touched_partitions_only(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    schema = "ANO int, k string, v int"
    first = rows([(2024, "a", 1), (2025, "a", 2), (2025, "b", 3)], schema)
    assert tables.upsert_partitions(path, first, ["ANO", "k"], ["ANO"])
    old = {f.name for f in (tmp_path / "t" / "ANO=2024").glob("*.parquet")}
    change = rows([(2025, "b", 30), (2026, "c", 4)], schema)
    assert tables.upsert_partitions(path, change, ["ANO", "k"], ["ANO"])
    assert content(spark.read.parquet(path), "ANO", "k", "v") == [
        (2024, "a", 1), (2025, "a", 2), (2025, "b", 30), (2026, "c", 4),
    ]
    assert {f.name for f in (tmp_path / "t" / "ANO=2024").glob("*.parquet")} == old
    assert not tables.upsert_partitions(path, change.limit(0), ["ANO", "k"], ["ANO"])
    with pytest.raises(ValueError):
        tables.upsert_partitions(path, change, ["k"], ["ANO"])


def test_correction_table(spark, rows, tmp_path):
    schema = "ChaveQuebrada string, ChaveCorreta string"
    table = VersionedTable(spark, str(tmp_path / "c"))
    tables.save_corrections(table, rows([("a", "b"), ("x", "x")], schema))
    tables.save_corrections(table, rows([("a", "c"), ("d", "e")], schema))
    assert content(table.read(), *schemas.KEY_CORRECTIONS.fieldNames()) == [("a", "c"), ("d", "e")]
    tables.replace_corrections(table, rows([], schema))
    assert table.read().count() == 2
    tables.replace_corrections(table, rows([("n", "m")], schema))
    assert content(table.read(), "ChaveQuebrada") == [("n",)]


def test_missing_correction_table_reads_as_empty(spark):
    found = readers.read_corrections(spark, "no_such_table")
    assert found.isEmpty() and found.columns == ["ChaveQuebrada", "ChaveCorreta"]


def test_existing_correction_table(spark, rows):
    rows([("a", "b", 1)], "ChaveQuebrada string, ChaveCorreta string, x int").createOrReplaceTempView("mapa")
    assert readers.read_corrections(spark, "mapa").collect() == [("a", "b")]


def test_snapshot_is_built_once_and_rebuilt_when_unreadable(spark, rows, tmp_path):
    built = []

    def build():
        built.append(1)
        return rows([("a", len(built))], ROW)

    table = VersionedTable(spark, str(tmp_path / "s"))
    for _ in range(2):
        assert snapshot(table, build).collect() == [("a", 1)]
    for part in (tmp_path / "s" / "data").glob("*/*.parquet"):
        part.write_bytes(b"broken")
    for checksum in (tmp_path / "s" / "data").glob("*/.*.crc"):
        checksum.write_bytes(b"")
    assert snapshot(table, build).collect() == [("a", 2)]
    assert table.version() == 2


def test_separated_file(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_bytes(
        "﻿nm_unidade_padronizada; final\nA;a\nB;b;extra;fields\nC\nA;last\nD;d;\n\"x;y\";z\n".encode()
    )
    found = as_dicts(lookup_files.read_unit_map(spark, str(path)).orderBy("linha"))
    assert [(r["nm_unidade_padronizada"], r["final"]) for r in found] == [
        ("A", "a"), ("C", None), ("A", "last"), ("D", "d"), ("x;y", "z"),
    ]
    assert lookup_files.read_unit_map(spark, str(path)).count() == 5
    surplus = lookup_files.bad_lines(spark, str(path)).select(lookup_files.LINE)
    assert surplus.collect() == [("B;b;extra;fields",)]


def test_lines_with_surplus_fields_are_rejected_whole(spark, tmp_path):
    path = tmp_path / "u.csv"
    lines = ["a;b", "z;3;;4", "x;1;;", '"q;r";"s ""t"";u"', '"q;r";2;3', 'w;"1";', "v; 5 ", "a;b", ";;", '"";"";""']
    path.write_text("\n".join(lines) + "\n")
    good = lookup_files.read_separated(spark, str(path)).orderBy("linha")
    assert good.select("a", "b").collect() == [
        ("x", "1"), ("q;r", 's "t";u'), ("w", "1"), ("v", " 5 "), ("a", "b"), (None, None),
    ]
    bad = lookup_files.bad_lines(spark, str(path)).orderBy("linha")
    assert [r[lookup_files.LINE] for r in bad.collect()] == ["z;3;;4", '"q;r";2;3', '"";"";""']


def test_reading_order_of_files_read_in_many_splits(spark, tmp_path):
    for part in range(3):
        lines = ["k;v", *(f"{i % 7};{part * 1000 + i}" for i in range(1000))]
        (tmp_path / f"part-{part}.csv").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        found = lookup_files.read_separated(spark, str(tmp_path))
        assert found.select("linha.bloco").distinct().count() > 3
        assert [int(r["v"]) for r in found.orderBy("linha").collect()] == list(range(3000))
        last = last_by_key(found, ["k"], "linha").collect()
        assert {r["k"]: int(r["v"]) for r in last} == {str(i % 7): 2000 + i for i in range(993, 1000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_line_with_the_readers_own_separator_stays_whole(spark, tmp_path):
    (tmp_path / "u.csv").write_text("a;b\nx\u0001y;1\n")
    assert lookup_files.read_separated(spark, str(tmp_path / "u.csv")).select("a", "b").collect() == [("x\u0001y", "1")]


def test_nature_file_keeps_the_last_text(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("Codigo;Descricao_Natureza_Orcamentaria;Descricao_Natureza_Orcamentaria_FINAL\n"
                    "1;Pessoal;X\n2; PESSOAL ;Y\n")
    found = as_dicts(lookup_files.read_nature_map(spark, str(path)))
    assert [r["Descricao_Natureza_Orcamentaria_FINAL"] for r in found] == ["Y"]
    (tmp_path / "bad.csv").write_text("a;b\n1;2\n")
    with pytest.raises(KeyError, match="Descricao_Natureza_Orcamentaria"):
        lookup_files.read_nature_map(spark, str(tmp_path / "bad.csv"))


def test_directory_file_has_no_nulls(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text(" unidade ,nome_novo,gerente,email\nBAURU,Escritório,,a@example.org\n")
    found = as_dicts(lookup_files.read_unit_directory(spark, str(path)))
    assert [(r["unidade"], r["gerente"], r["email"]) for r in found] == [("BAURU", "", "a@example.org")]


def test_json_map_file(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"a|b|c|1": "x|b|c|1", "é": "ê"}, indent=1, ensure_ascii=False))
    found = content(lookup_files.read_json_map(spark, str(path)), "ChaveQuebrada", "ChaveCorreta")
    assert found == [("a|b|c|1", "x|b|c|1"), ("é", "ê")]


def test_json_maps_are_read_by_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n  "a|b|c|1": "x, \\"y\\"|b|c|1",\n  "k": "first"\n}\n')
    (tmp_path / "b.json").write_text('{"k": "last", "m": "n"}\n{"o": "p"}\n')
    found = content(lookup_files.read_json_map(spark, str(tmp_path)), "ChaveQuebrada", "ChaveCorreta")
    assert found == [("a|b|c|1", 'x, "y"|b|c|1'), ("k", "last"), ("m", "n"), ("o", "p")]
    (tmp_path / "b.json").unlink()
    (tmp_path / "a.json").write_text('{"k":\n"first", "k":\n"last",\n"é": "ê"}')
    found = content(lookup_files.read_json_map(spark, str(tmp_path)), "ChaveQuebrada", "ChaveCorreta")
    assert found == [("k", "last"), ("é", "ê")]


def test_correction_jobs(spark, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "c"))
    (tmp_path / "m.json").write_text(json.dumps({"a|A|U|1": "b|A|U|1", "old": "new"}, indent=1))
    assert tables.load_corrections_job(table, str(tmp_path / "m.json")) == 1
    schema = "CHAVE_CONCAT_original string, CHAVE_CONCAT string"
    result = rows([("a|A|U|1", "c|A|U|1"), ("a|A|U|1", "c|A|U|1"), ("same", "same"), (None, "x")], schema)
    assert tables.rebuild_corrections_job(table, result, keep_others=True) == 2
    names = schemas.KEY_CORRECTIONS.fieldNames()
    assert content(table.read(), *names) == [("a|A|U|1", "c|A|U|1"), ("old", "new")]
    assert tables.rebuild_corrections_job(table, result) == 3
    assert content(table.read(), *names) == [("a|A|U|1", "c|A|U|1")]
    assert tables.rebuild_corrections_job(table, result.filter("false")) == 3


def test_a_correction_saved_meanwhile_is_not_lost(spark, rows, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "c"))
    tables.save_corrections(table, rows([("a", "b")], schemas.KEY_CORRECTIONS))
    slow = VersionedTable(spark, table.root)
    slow.version = lambda: 1  # the job began before the other writer's load
    tables.save_corrections(table, rows([("c", "d")], schemas.KEY_CORRECTIONS))
    with pytest.raises(CommitConflict):
        tables.rebuild_corrections_job(slow, rows([("x", "y")], "CHAVE_CONCAT_original string, CHAVE_CONCAT string"))
    assert content(table.read(), "ChaveQuebrada") == [("a",), ("c",)]


def test_absent_sources_read_as_empty(spark, rows):
    absent = readers.catalog_table(spark, "no_such_commitments", schemas.COMMITTED)
    assert absent.isEmpty() and absent.schema == schemas.COMMITTED
    rows([("1.2", "2025", 3.0, 1.5, "x")], "CODCCUSTO string, ANO string, MES double, COMPROMETIDO double, extra string").createOrReplaceTempView("reservas")
    found = readers.catalog_table(spark, "reservas", schemas.COMMITTED)
    assert found.schema == schemas.COMMITTED and found.collect() == [("1.2", 2025, 3, Decimal("1.50"))]
    rows([(1,)], "x int").createOrReplaceTempView("sem_colunas")
    with pytest.raises(KeyError, match="CODCCUSTO"):
        readers.catalog_table(spark, "sem_colunas", schemas.COMMITTED)


def test_query_files(spark, tmp_path):
    path = tmp_path / "q.sql"
    path.write_text("SELECT * FROM minha_tabela;", encoding="utf-8")
    assert sql_files.load_sql(path) == "SELECT * FROM minha_tabela;"
    with pytest.raises(FileNotFoundError):
        sql_files.load_sql(tmp_path / "none.sql")
    path.write_text("SELECT :n + 1 AS m")
    assert sql_files.run_sql(spark, path, n=2).collect() == [(3,)]


def test_conform(rows):
    df = rows([(datetime(2025, 1, 2, 23), float("nan"), "2025.0", 5)],
              "DATA timestamp, VALOR double, ANO string, extra int")
    schema = schemas._schema(DATA=schemas.DATE, VALOR=schemas.AMOUNT, ANO=schemas.INT)
    row = readers.conform(df, schema).first()
    assert row["DATA"].isoformat() == "2025-01-02" and row["VALOR"] is None and row["ANO"] == 2025
    with pytest.raises(KeyError, match="CC"):
        readers.conform(df, schemas.LEDGER)


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "t")
    assert "numPartitions" not in plain
    split = readers.jdbc_options("jdbc:x", "t", "id", (1, 100), 8)
    assert split["numPartitions"] == "8" and split["upperBound"] == "100"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", partitions=8)


def test_unit_extracts_and_brazilian_csv(spark, rows, tmp_path):
    df = rows([("U V", Decimal("1234.50"), 1.5e9, 1), ("W/X", Decimal("-0.10"), 0.25, 2)],
              "UNIDADE_FINAL string, valor decimal(18,2), d double, n int")
    names = df.select("UNIDADE_FINAL", F.translate("UNIDADE_FINAL", " /", "__").alias("unit_slug"))
    extracts.write_unit_extracts(df, names, str(tmp_path / "e"))
    assert {p.name for p in (tmp_path / "e").glob("unit_slug=*")} == {"unit_slug=U_V", "unit_slug=W_X"}
    assert spark.read.parquet(str(tmp_path / "e")).count() == 2
    extracts.write_unit_extracts(df, names, str(tmp_path / "c"), "csv")
    extracts.write_brazilian_csv(df.coalesce(1), str(tmp_path / "b"))
    lines = next((tmp_path / "b").glob("*.csv")).read_text().splitlines()
    back = extracts.read_unit_extracts(df, names, str(tmp_path / "e"))
    assert content(back, "UNIDADE_FINAL", "n", "unit_slug") == [("U V", 1, "U_V"), ("W/X", 2, "W_X")]
    assert extracts.read_unit_extracts(df, names, str(tmp_path / "c"), "csv").count() == 2
    with pytest.raises(ValueError, match="W_X"):
        extracts.read_unit_extracts(df, names.filter("unit_slug = 'U_V'"), str(tmp_path / "e"))
    assert lines == ["UNIDADE_FINAL;valor;d;n", "U V;1234,50;1500000000,000000;1", "W/X;-0,10;0,25;2"]


def test_orders_are_joined_before_other_tables_and_flows_are_read_once(spark):
    from orcaspark.plans import loads
    from orcaspark.sources import star

    plan = star.planned_lines(spark, "/root/testdata/sf0.001", 1997)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" in [line for line in plan.splitlines() if "Join" in line][-1]
    read = spark.sparkContext.accumulator(0)

    def seen(value):
        read.add(1)
        return value

    flow = spark.createDataFrame([(1, "c", "P")] * 3, "MES int, CODCCUSTO string, PROJETO string")
    from pyspark.sql import functions as F

    flow = flow.withColumn("CODCCUSTO", F.udf(seen)("CODCCUSTO")).withColumn("Valor_Ajustado", F.lit(1).cast("decimal(18,2)"))
    found = {r["fluxo"]: r["rejeitados"] for r in loads.usable_flows(flow, flow).collect()}
    assert found == {"planejado": 0, "comprometido": 0, "sem centro": 3} and read.value == 6
