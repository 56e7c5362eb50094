"""Budget tables derived from an order-entry star schema.

The star schema (``lineitem orders part supplier nation region``) plays the part
of the accounting systems: every order line is one ledger posting, ordered value
is planned value, tax is committed value. Suppliers and brands are projects (a
third of the suppliers own an exclusive project; brands are shared), part types
are actions, nations are units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.functions.numbers import AMOUNT
from orcaspark.lookups import PLANNED_CAPTIONS
from orcaspark.session import stage

# Nature text per account, as typed by planners and by bookkeeping.
# None: the planners left the text empty.
PLANNED_NATURES = {
    "3.1.A.F": "Bens Móveis",
    "3.1.A.O": "Serviços Especializados",
    "3.1.N.F": "Despesas com Viagens",
    "3.1.N.O": "Aluguéis e Encargos",
    "3.1.R.F": "Demais Custos e Despesas Gerais",
    "3.1.R.O": None,
}
LEDGER_NATURES = {
    "3.1.A.F": "BENS MÓVEIS",
    "3.1.A.O": "SERVIÇOS ESPECIALIZADOS - PJ",
    "3.1.N.F": "DESPESAS COM VIAGENS E LOCOMOÇÃO",
    "3.1.N.O": "ALUGUEIS E ENCARGOS",
    "3.1.R.F": "demais custos e despesas gerais ",
    "3.1.R.O": "RUBRICA LOCAL",
}


# Declared so that opening a table needs no job that reads file footers.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}

# Exact types whose products stay within 18 digits, where Spark computes on longs.
QUANTITY, UNIT_PRICE, PRICE, RATE = "decimal(7,2)", "decimal(10,2)", "decimal(12,2)", "decimal(4,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the star schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text_of(code: Column, texts: dict[str, str | None]) -> Column:
    chain = F
    for value, text in texts.items():
        chain = chain.when(code == value, F.lit(text))
    return chain


def _center_code() -> Column:
    """Project number, action and nation as a 5.6.4 character code."""
    return F.concat_ws(
        ".",
        F.lpad(F.col("numero").cast("string"), 5, "0"),
        F.left(F.rpad("ACAO", 6, "_"), F.lit(6)),
        F.lpad(F.col("n_nationkey").cast("string"), 4, "0"),
    )


def _nature_code() -> Column:
    return F.concat_ws(".", F.lit("3.1"), "l_returnflag", "l_linestatus")


def order_lines(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines (all, or those given) with the budget keys; unused columns are pruned by the caller's plan."""
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    exclusive = F.col("l_suppkey") % 3 == 0
    number = F.when(exclusive, F.col("l_suppkey") + 10000).otherwise(
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("bigint")
    )
    keyed = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumns(
            {
                "PROJETO": F.when(exclusive, F.col("s_name")).otherwise(F.col("p_brand")),
                "ACAO": F.col("p_type"),
                "numero": number,
            }
        )
    )
    return keyed.withColumns({"CC": _center_code(), "NATUREZA": _nature_code()})


def orders_of(spark: SparkSession, sf_dir: str, year: int | None) -> DataFrame:
    """Orders of one year, as a date range that reaches the scan; of all years without one."""
    orders = table(spark, sf_dir, "orders")
    if year is None:
        return orders
    placed = F.col("o_orderdate")
    return orders.filter(
        (placed >= F.to_timestamp(F.lit(f"{year}-01-01"))) & (placed < F.to_timestamp(F.lit(f"{year + 1}-01-01")))
    )


def _ordered_lines(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """Order lines with their orders, which are joined first: keys and numbers travel, and only lines of the year."""
    orders = orders_of(spark, sf_dir, year).select("o_orderkey", "o_orderdate", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return order_lines(spark, sf_dir, lines)


def budget_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What plan, corrections and cost centres of all years are made from, written once for a query that needs several."""
    columns = ("o_orderdate", "o_orderpriority", "PROJETO", "ACAO", "n_name", "numero", "n_nationkey",
               "l_returnflag", "l_linestatus", "l_quantity", "p_retailprice", "CC")
    return stage(_ordered_lines(spark, sf_dir).select(*columns), "linhas")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executed postings. Half of the unit names carry the state prefix."""
    unit = F.when(
        F.col("l_linestatus") == "O", F.concat(F.lit("SP - "), F.col("n_name"))
    ).otherwise(F.col("n_name"))
    group = (
        F.when(F.col("l_returnflag") == "A", "DESPESAS")
        .when(F.col("l_returnflag") == "R", "DESPESAS EXCLUSIVAS DO ORÇAMENTO")
        .otherwise("RECEITAS")
    )
    net = F.col("l_extendedprice").cast(PRICE) * (F.lit(1) - F.col("l_discount").cast(RATE))
    return order_lines(spark, sf_dir).select(
        F.to_date("l_shipdate").alias("DATA"),
        "PROJETO",
        "ACAO",
        unit.alias("UNIDADE"),
        "CC",
        F.col("NATUREZA").alias("cdgContaNvl4"),
        _text_of(F.col("NATUREZA"), LEDGER_NATURES).alias("DESCNVL4"),
        group.alias("DESCNVL1"),
        F.col("s_name").alias("FORNECEDOR"),
        net.cast(AMOUNT).alias("VALOR"),
    )


def planned_lines(
    spark: SparkSession, sf_dir: str, year: int | None = None, lines: DataFrame | None = None
) -> DataFrame:
    """Planned value of each line under short keys; long texts are added after summing."""
    lines = _ordered_lines(spark, sf_dir, year) if lines is None else lines
    value = F.col("l_quantity").cast(QUANTITY) * F.col("p_retailprice").cast(UNIT_PRICE)
    return lines.select(
        F.year("o_orderdate").alias("ANO"),
        F.month("o_orderdate").alias("MES"),
        "PROJETO",
        "ACAO",
        F.col("n_name").alias("UNIDADE"),
        "numero",
        "n_nationkey",
        "l_returnflag",
        "l_linestatus",
        "o_orderpriority",
        value.cast(AMOUNT).alias("Valor_Ajustado"),
    )


def summed(lines: DataFrame, *keys: str) -> DataFrame:
    """Planned value per key."""
    return lines.groupBy(*keys).agg(F.sum("Valor_Ajustado").cast(AMOUNT).alias("Valor_Ajustado"))


def _with_texts(planned: DataFrame) -> DataFrame:
    """Nature and plan columns in place of the line flags."""
    code = _nature_code()
    return planned.withColumns(
        {
            "Codigo_Natureza_Orcamentaria": code,
            "Descricao_Natureza_Orcamentaria": _text_of(code, PLANNED_NATURES),
            "Descricao_PPA": F.concat(F.lit("PPA "), "ANO"),
        }
    ).drop("l_returnflag", "l_linestatus")


def with_center(planned: DataFrame) -> DataFrame:
    """Cost-centre code in place of the project number and nation key."""
    return planned.withColumn("CODCCUSTO", _center_code()).drop("numero", "n_nationkey")


_MONTHLY = ("ANO", "MES", "PROJETO", "ACAO", "UNIDADE", "l_returnflag", "l_linestatus")


def planned_enriched(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """Planned amounts that already carry their cost centre."""
    lines = planned_lines(spark, sf_dir, year)
    return with_center(_with_texts(summed(lines, *_MONTHLY, "numero", "n_nationkey")))


def planned_raw(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Planned amounts before enrichment; urgent orders were typed with a broken project name."""
    typed = F.when(
        F.col("o_orderpriority") == "1-URGENT", F.replace("PROJETO", F.lit("#"), F.lit(" "))
    ).otherwise(F.col("PROJETO"))
    typed_lines = planned_lines(spark, sf_dir, lines=lines).withColumn("PROJETO", typed)
    return _with_texts(summed(typed_lines, *_MONTHLY))


def planned_cube_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``planned_raw`` as the source cube delivers it: long captions, prefixed units."""
    captions = {short: long for long, short in PLANNED_CAPTIONS.items()}
    raw = planned_raw(spark, sf_dir).withColumn("UNIDADE", F.concat(F.lit("SP - "), "UNIDADE"))
    return raw.select(*[F.col(name).alias(captions[name]) for name in raw.columns])


def corrections(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Known repairs: the broken keys planned before 1998."""
    urgent = (F.col("o_orderpriority") == "1-URGENT") & F.contains("PROJETO", F.lit("#"))
    known = (
        planned_lines(spark, sf_dir, lines=lines)
        .filter(urgent & (F.col("ANO") < 1998))
        .select("PROJETO", "ACAO", "UNIDADE", F.col("ANO").cast("string"))
        .distinct()
    )
    broken = F.replace("PROJETO", F.lit("#"), F.lit(" "))
    return known.select(
        F.concat_ws("|", broken, "ACAO", "UNIDADE", "ANO").alias("ChaveQuebrada"),
        F.concat_ws("|", "PROJETO", "ACAO", "UNIDADE", "ANO").alias("ChaveCorreta"),
    )


def cost_center_raw(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Every cost-centre node: leaf (unit), 12-character action and 5-character project."""
    lines = _ordered_lines(spark, sf_dir) if lines is None else lines
    leaves = (
        lines.groupBy("CC", "n_name", "PROJETO", "ACAO")
        .agg(F.min("o_orderdate").alias("desde"))
    )
    nodes = F.array(
        F.struct(F.col("CC").alias("codigo"), F.col("n_name").alias("nome")),
        F.struct(F.left("CC", F.lit(12)).alias("codigo"), F.col("ACAO").alias("nome")),
        F.struct(F.left("CC", F.lit(5)).alias("codigo"), F.col("PROJETO").alias("nome")),
    )
    return (
        leaves.select("desde", F.inline(nodes))
        .groupBy(F.col("codigo").alias("CODCCUSTO"), F.col("nome").alias("CAMPOLIVRE"))
        .agg(F.min("desde").alias("RECCREATEDON"))
    )


def commit_header(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """One budget commitment per order, booked on the first truncated code of its lines."""
    return (
        _ordered_lines(spark, sf_dir, year)
        .groupBy("o_orderkey", F.year("o_orderdate").alias("ANOORCAMENTO"))
        .agg(F.min(F.left("CC", F.lit(12))).alias("CODCCUSTO"))
        .select(F.lit(1).alias("CODCOLIGADA"), F.col("o_orderkey").alias("IDORCAMENTO"), "CODCCUSTO", "ANOORCAMENTO")
    )


def commit_item(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """One committed amount per order line, in the month of the order."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_tax", "l_extendedprice")
    orders = orders_of(spark, sf_dir, year).select("o_orderkey", "o_orderdate")
    value = F.col("l_tax").cast(RATE) * F.col("l_extendedprice").cast(PRICE)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.lit(1).alias("CODCOLIGADA"),
        F.col("l_orderkey").alias("IDORCAMENTO"),
        F.month("o_orderdate").alias("SEQITMORCA"),
        value.cast(AMOUNT).alias("VALOROPCIONAL1"),
    )


def chart_of_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts in use, in lower case, and their parents."""
    used = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    leaf = used.select(
        F.lower(F.concat_ws(".", F.lit("3.1"), "l_returnflag", "l_linestatus")).alias("CODCONTA"),
        F.concat(F.lit("CONTA "), "l_returnflag", F.lit("/"), "l_linestatus").alias("DESCRICAO"),
    )
    parent = used.select(
        F.lower(F.concat_ws(".", F.lit("3.1"), "l_returnflag")).alias("CODCONTA"),
        F.concat(F.lit("GRUPO "), "l_returnflag").alias("DESCRICAO"),
    ).distinct()
    return leaf.unionByName(parent)


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


def unit_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of one region share a final name, those of another are renamed, others are absent."""
    final = F.when(F.col("r_name") == "AFRICA", F.lit("UNIDADE AFRICA")).when(
        F.col("r_name") == "AMERICA",
        F.concat(F.lit("ESCRITORIO "), F.col("n_name")),
    )
    return (
        _nations(spark, sf_dir)
        .select(F.col("n_name").alias("nm_unidade_padronizada"), final.alias("final"))
        .filter(F.col("final").isNotNull())
    )


def unit_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display names for the units of one region; the others fall back to their own."""
    name = F.col("n_name")
    return (
        _nations(spark, sf_dir)
        .filter(F.col("r_name") == "AMERICA")
        .select(
            F.concat(F.lit(" escritorio "), F.lower(name), F.lit(" ")).alias("unidade"),
            F.concat(F.lit("Escritório / "), F.initcap(name)).alias("nome_novo"),
            F.concat(F.lit("Responsavel "), name).alias("gerente"),
            F.concat(F.lower(name), F.lit("@example.org")).alias("email"),
            F.lit("Prezada equipe").alias("tratamento"),
            F.lit(None).cast("string").alias("equipe"),
        )
    )
