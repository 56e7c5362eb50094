"""Table schemas of the budget domain."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from orcaspark.functions.numbers import AMOUNT


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


TEXT, INT, LONG, DATE, STAMP = StringType(), IntegerType(), LongType(), DateType(), TimestampType()

PLANNED_RAW = _schema(
    PROJETO=TEXT,
    ACAO=TEXT,
    UNIDADE=TEXT,
    ANO=INT,
    MES=INT,
    Descricao_PPA=TEXT,
    Codigo_Natureza_Orcamentaria=TEXT,
    Descricao_Natureza_Orcamentaria=TEXT,
    Valor_Ajustado=AMOUNT,
)
LEDGER = _schema(
    DATA=DATE,
    PROJETO=TEXT,
    ACAO=TEXT,
    UNIDADE=TEXT,
    CC=TEXT,
    cdgContaNvl4=TEXT,
    DESCNVL4=TEXT,
    DESCNVL1=TEXT,
    FORNECEDOR=TEXT,
    VALOR=AMOUNT,
)
COST_CENTER_RAW = _schema(CODCCUSTO=TEXT, CAMPOLIVRE=TEXT, RECCREATEDON=STAMP)
COST_CENTER = _schema(
    CODCCUSTO=TEXT,
    ACAO=TEXT,
    PROJETO=TEXT,
    UNIDADE=TEXT,
    DTUNIDADE=STAMP,
    DTPROJETO=STAMP,
    DTACAO=STAMP,
)
COMMIT_HEADER = _schema(CODCOLIGADA=INT, IDORCAMENTO=LONG, CODCCUSTO=TEXT, ANOORCAMENTO=INT)
COMMIT_ITEM = _schema(CODCOLIGADA=INT, IDORCAMENTO=LONG, SEQITMORCA=INT, VALOROPCIONAL1=AMOUNT)
COMMITTED = _schema(CODCCUSTO=TEXT, ANO=INT, MES=INT, COMPROMETIDO=AMOUNT)
CHART_OF_ACCOUNTS = _schema(CODCONTA=TEXT, DESCRICAO=TEXT)
KEY_CORRECTIONS = _schema(ChaveQuebrada=TEXT, ChaveCorreta=TEXT)
UNIT_MAP = _schema(nm_unidade_padronizada=TEXT, final=TEXT)
NATURE_MAP = _schema(
    Codigo_Natureza_Orcamentaria=TEXT,
    Descricao_Natureza_Orcamentaria=TEXT,
    Descricao_Natureza_Orcamentaria_FINAL=TEXT,
)
UNIT_DIRECTORY = _schema(
    unidade=TEXT, nome_novo=TEXT, gerente=TEXT, email=TEXT, tratamento=TEXT, equipe=TEXT
)
