"""Named queries over what readers read and sinks write: each writes given tables and reads them back.

What they write lies in the staging folder of the application, each time in a folder of its own.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.lookups import NATURE_STANDARD, NATURE_TEXT
from orcaspark.operators import keys, quality, reports, units
from orcaspark.operators.rows import READING_ORDER, last_by_key, require_columns
from orcaspark.plans import pipeline
from orcaspark.schemas import COMMITTED, KEY_CORRECTIONS, PLANNED_RAW
from orcaspark.session import scratch, stage
from orcaspark.sinks import extracts, tables
from orcaspark.sources import lookup_files, sql_files, star
from orcaspark.sources.tables import catalog_table, read_table
from orcaspark.sources.versioned import VersionedTable, snapshot

QUERY_FILE = Path(__file__).with_name("consulta_centro.sql")
LEAST_AMOUNT = 100_000


def new_table(spark: SparkSession, label: str) -> VersionedTable:
    return VersionedTable(spark, scratch(spark, label))


def text_file(lines: DataFrame, value: Column, header: str, order: str) -> str:
    """Write a text line a row, files in the order of a column, each with the header; return the path."""
    path = scratch(lines.sparkSession, "arquivo")
    rows = lines.repartitionByRange(order).sortWithinPartitions(order).select(value.alias(header))
    raw = {"sep": "\u0001", "quote": "\u0000", "escapeQuotes": "false", "header": "true"}
    rows.write.options(**raw).csv(path)
    return path


def separated(columns: list[str], df: DataFrame, sep: str, order: str) -> str:
    """Write a separated file of text columns; return the path."""
    fields = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in columns]
    line = F.concat_ws(sep, *[F.coalesce(f, F.lit("")) for f in fields])
    return text_file(df, line, sep.join(columns), order)


# -- readers ------------------------------------------------------------------------------


def planned_scan(spark, d):
    """Planned rows stored with other types and columns, read in the declared ones."""
    path = scratch(spark, "planejado")
    raw = star.planned_raw(spark, d)
    raw.withColumns({"ANO": F.col("ANO").cast("string"), "Valor_Ajustado": F.col("Valor_Ajustado").cast("string"),
                     "sobra": F.lit(1)}).write.parquet(path)
    return read_table(spark, path, PLANNED_RAW)


def order_file(spark, d) -> str:
    """Orders as lines of customer, order and quoted text; those of the highest priority have surplus fields."""
    orders = star.table(spark, d, "orders")
    quoted = F.concat(F.lit('"'), "o_orderpriority", F.lit(';""'), "o_orderstatus", F.lit('"""'))
    line = F.concat_ws(";", "o_custkey", "o_orderkey", quoted)
    surplus = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(line, F.lit(";;4")))
    closed = F.when(F.col("o_orderstatus") == "F", F.concat(line, F.lit(";;")))
    return text_file(orders, F.coalesce(surplus, closed, line), "cliente; pedido;texto", "o_orderkey")


def file_last_rows(spark, d):
    """The last sound line of each customer."""
    rows = lookup_files.read_separated(spark, order_file(spark, d))
    return last_by_key(rows, ["cliente"], READING_ORDER).drop(READING_ORDER)


def file_bad_lines(spark, d):
    """The lines with surplus fields, whole."""
    return lookup_files.bad_lines(spark, order_file(spark, d)).select(lookup_files.LINE)


def unit_map_file(spark, d):
    """Unit map from a file in which each unit stands twice; the last row counts."""
    rows = star.unit_map(spark, d)
    twice = rows.withColumns({"final": F.concat(F.lit("ZZ "), "final"), "vez": F.lit(0)}).unionByName(rows.withColumn("vez", F.lit(1)))
    path = separated(rows.columns, twice, ";", "vez")
    read = lookup_files.read_unit_map(spark, path)
    return last_by_key(read, ["nm_unidade_padronizada"], READING_ORDER).drop(READING_ORDER)


def directory_file(spark, d):
    rows = star.unit_directory(spark, d)
    return lookup_files.read_unit_directory(spark, separated(rows.columns, rows, ",", "unidade")).drop(READING_ORDER)


def nature_file(spark, d):
    """Nature map from a file of the natures planned, each in two spellings; the last row counts."""
    planned = star.planned_enriched(spark, d).filter(F.col(NATURE_TEXT).isNotNull())
    code = F.col("Codigo_Natureza_Orcamentaria")
    names = planned.select(code, NATURE_TEXT).distinct()
    last = names.withColumns({NATURE_STANDARD: F.concat(F.lit("Natureza "), code), "vez": F.concat(F.lit("1"), code)})
    first = names.withColumns({
        NATURE_TEXT: F.concat(F.lit(" "), F.lower(NATURE_TEXT)),
        NATURE_STANDARD: F.lit("antes"),
        "vez": F.concat(F.lit("0"), code),
    })
    rows = first.unionByName(last)
    path = separated(["Codigo_Natureza_Orcamentaria", NATURE_TEXT, NATURE_STANDARD], rows, ";", "vez")
    return lookup_files.read_nature_map(spark, path).drop(READING_ORDER)


def query_file(spark, d):
    """A query kept in a file, with named parameters, over a table checked for its columns."""
    planned = star.planned_enriched(spark, d)
    require_columns(planned, ["CODCCUSTO", "ANO", "Descricao_PPA", "Valor_Ajustado"], "planned")
    planned.createOrReplaceTempView("planejado_com_centro")
    return sql_files.run_sql(spark, QUERY_FILE, ano=1997, ppa="PPA 1997", minimo=LEAST_AMOUNT)


# -- sources that may be absent ------------------------------------------------------------


def commitments_if_any(committed: DataFrame) -> DataFrame:
    """Commitments from a table that exists, and from one that doesn't, by the same call."""
    spark = committed.sparkSession
    committed.createOrReplaceTempView("comprometidos")
    absent = catalog_table(spark, "comprometidos_de_outro_ano", COMMITTED)
    return catalog_table(spark, "comprometidos", COMMITTED).unionByName(absent)


def corrections_if_any(spark, d):
    """The same for corrections."""
    star.corrections(spark, d).withColumn("sobra", F.lit(1)).createOrReplaceTempView("mapa_de_chaves")
    absent = catalog_table(spark, "mapa_de_chaves_inexistente", KEY_CORRECTIONS)
    return catalog_table(spark, "mapa_de_chaves", KEY_CORRECTIONS).unionByName(absent)


def usable_flows(enriched: DataFrame, booked: DataFrame) -> DataFrame:
    """Whether each flow has a usable row, and the rows a run saves of one that has none."""
    spark = enriched.sparkSession
    enriched, booked = stage(enriched, "planejado"), stage(booked, "comprometido")
    nothing = booked.withColumn("CODCCUSTO", F.lit(None).cast("string"))
    rows = []
    for name, flow in (("planejado", enriched), ("comprometido", booked), ("sem centro", nothing)):
        saved, left_out = pipeline.save(flow, new_table(spark, "fluxo"))
        rows.append((name, quality.usable(flow), saved is not None, left_out.count()))
    return spark.createDataFrame(rows, "fluxo string, aproveitavel boolean, salvo boolean, rejeitados bigint")


# -- keyed loads and snapshots ---------------------------------------------------------------

UPSERT_KEYS = ["ANO", "MES", "PROJETO", "ACAO", "CODCCUSTO"]


def plan_of(spark, d, status: str) -> DataFrame:
    """Planned value of the lines of one status by the load's keys."""
    of_status = star.planned_lines(spark, d).filter(F.col("l_linestatus") == status)
    by = ["ANO", "MES", "PROJETO", "ACAO", "numero", "n_nationkey"]
    return star.with_center(star.summed(of_status, *by))


def upsert_written(spark, d):
    """Two loads of a stored table, and an empty one that changes nothing."""
    table = new_table(spark, "plano")
    tables.upsert(table, plan_of(spark, d, "F"), UPSERT_KEYS)
    version = tables.upsert(table, plan_of(spark, d, "O"), UPSERT_KEYS)
    if tables.upsert(table, plan_of(spark, d, "none"), UPSERT_KEYS) != version:
        raise RuntimeError("an empty load made a version")
    return table.read()


def upsert_keys_written(spark, d):
    """Keys of a load without other columns: new ones are inserted, known ones keep their amounts."""
    table = new_table(spark, "plano")
    tables.upsert(table, plan_of(spark, d, "F"), UPSERT_KEYS)
    tables.upsert(table, plan_of(spark, d, "O").select(*UPSERT_KEYS), UPSERT_KEYS)
    return table.read()


def snapshot_read(build) -> DataFrame:
    """A snapshot built once and read by name by a second caller, who may not build it again."""
    rows = build()
    table = new_table(rows.sparkSession, "instantaneo")
    snapshot(table, lambda: rows)

    def again():
        raise RuntimeError("the snapshot was built twice")

    return snapshot(VersionedTable(table.spark, table.root), again)


def corrections_saved(spark, d):
    """Corrections saved in two loads; those without a change are skipped, later ones count."""
    known = stage(star.corrections(spark, d), "correcoes")
    table = new_table(spark, "mapa")
    broken = F.col("ChaveQuebrada")
    first = known.withColumn("ChaveCorreta", F.concat(F.lit("antes "), "ChaveCorreta"))
    tables.save_corrections(table, first.unionByName(known.select(F.concat(broken, F.lit(" igual")).alias("ChaveQuebrada"), F.concat(broken, F.lit(" igual")).alias("ChaveCorreta"))))
    tables.save_corrections(table, known)
    return table.read()


def corrections_rebuilt(enriched: DataFrame) -> DataFrame:
    """Corrections replaced by those that a stored result implies."""
    spark = enriched.sparkSession
    result = stage(enriched, "resultado")
    table = new_table(spark, "mapa")
    tables.replace_corrections(table, spark.createDataFrame([("x|a|u|1", "y|a|u|1")], KEY_CORRECTIONS))
    tables.rebuild_corrections_job(table, spark.read.parquet(*result.inputFiles()).select(keys.ORIGINAL_KEY, keys.KEY))
    return table.read()


def corrections_loaded(spark, d):
    """Corrections loaded from JSON files with an object on each line."""
    known = star.corrections(spark, d)
    path = scratch(spark, "json")
    known.select(F.to_json(F.create_map("ChaveQuebrada", "ChaveCorreta")).alias("value")).write.text(path)
    table = new_table(spark, "mapa")
    tables.load_corrections_job(table, path)
    return table.read()


# -- folders by unit ---------------------------------------------------------------------------


def extract_read(rows: DataFrame, names: DataFrame, source: str = "parquet") -> DataFrame:
    """Rows written to a folder a unit and read back with the folder's name."""
    rows, names = stage(rows, "extrato"), stage(names, "unidades")
    path = scratch(rows.sparkSession, "extratos")
    extracts.write_unit_extracts(rows, names, path, source)
    return extracts.read_unit_extracts(rows, names, path, source)


def documents_read(base: DataFrame, names) -> DataFrame:
    """Chart documents written to a file a unit, read back as their entries by folder."""
    spark = base.sparkSession
    cube = stage(reports.report_cube(base), "cubo")
    named = stage(names(cube), "unidades")
    path = scratch(spark, "graficos")
    extracts.write_unit_documents(units.unit_documents(cube, named), path)
    read = extracts.read_unit_documents(spark, path)
    return units.document_rows(read.join(named.select(reports.UNIT, extracts.SLUG), extracts.SLUG))


# -- whole run -----------------------------------------------------------------------------------


def enrichment_run(spark, d, committed: DataFrame):
    """Two whole runs over one output: the rows of some years, then those of all."""
    out = scratch(spark, "execucao")
    lines = star.budget_lines(spark, d)
    raw = stage(star.planned_raw(spark, d, lines), "bruto")
    centres = stage(star.cost_center_raw(spark, d, lines), "centros")
    inputs = (centres, stage(committed, "comprometido"), stage(star.corrections(spark, d, lines), "correcoes"))
    pipeline.run_enrichment(spark, raw.filter("ANO < 1996"), *inputs, out)
    return pipeline.run_enrichment(spark, raw, *inputs, out)
