"""Fixed reference values used by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Level-1 ledger descriptions that count as spending.
EXPENSE_GROUPS = ["DESPESAS", "DESPESAS EXCLUSIVAS DO ORÇAMENTO"]

# Source captions of the planned cube and the short column names.
PLANNED_CAPTIONS = {
    "[Iniciativa].[Iniciativas].[Iniciativa].[MEMBER_CAPTION]": "PROJETO",
    "[Ação].[Ação].[Nome de Ação].[MEMBER_CAPTION]": "ACAO",
    "[Unidade Organizacional de Ação].[Unidade Organizacional de Ação].[Nome de Unidade Organizacional de Ação].[MEMBER_CAPTION]": "UNIDADE",
    "[Tempo].[Ano].[Número Ano].[MEMBER_CAPTION]": "ANO",
    "[Tempo].[Mês].[Número Mês].[MEMBER_CAPTION]": "MES",
    "[PPA].[PPA com Fotografia].[Descrição de PPA com Fotografia].[MEMBER_CAPTION]": "Descricao_PPA",
    "[Natureza Orçamentária].[Código Estruturado 4 nível].[Código Estruturado 4 nível].[MEMBER_CAPTION]": "Codigo_Natureza_Orcamentaria",
    "[Natureza Orçamentária].[Descrição de Natureza 4 nível].[Descrição de Natureza 4 nível].[MEMBER_CAPTION]": "Descricao_Natureza_Orcamentaria",
    "[Measures].[ValorAjustado]": "Valor_Ajustado",
}

# Expense-nature texts and their standard form, in code order.
NATURE_NAMES = [
    ("Pessoal", "Pessoal"),
    ("Encargos Sociais", "Encargos Sociais"),
    ("Benefícios Sociais", "Benefícios Sociais"),
    ("Serviços Especializados", "Serviços Especializados"),
    ("SERVIÇOS ESPECIALIZADOS - PJ", "Serviços Especializados"),
    ("Serviços Contratados", "Serviços Contratados"),
    ("SERVIÇOS CONTRATADOS - PJ", "Serviços Contratados"),
    ("Encargos Sociais s/Serviços de Terceiros", "Encargos Sociais S/Serviços De Terceiros"),
    ("ENCARGOS SOCIAIS S/ SERVIÇOS DE TERCEIROS", "Encargos Sociais S/Serviços De Terceiros"),
    ("DESPESAS COM VIAGENS E LOCOMOÇÃO", "Despesas Com Viagens"),
    ("Despesas com Viagens", "Despesas Com Viagens"),
    ("Aluguéis e Encargos", "Aluguéis E Encargos"),
    ("ALUGUÉIS E ENCARGOS - PESSOA JURÍDICA (PJ)", "Aluguéis E Encargos"),
    ("Divulgação, Anúncios, Publicidade e Propaganda", "Divulgação, Anúncios, Publicidade E Propaganda"),
    ("Serviços Gráficos e de Reprodução", "Serviços Gráficos E De Reprodução"),
    ("Serviços de Comunicação em Geral", "Serviços De Comunicação Em Geral"),
    ("Materiais de Consumo", "Materiais De Consumo"),
    ("DEMAIS CUSTOS E DESPESAS GERAIS - PJ", "Demais Custos E Despesas Gerais"),
    ("Demais Custos e Despesas Gerais", "Demais Custos E Despesas Gerais"),
    ("Doações e Subvenções", "Doações E Subvenções"),
    ("DESPESAS TRIBUTÁRIAS", "Despesas Tributárias"),
    ("DESPESAS FINANCEIRAS", "Despesas Financeiras"),
    ("Transf. Externas - Convênios c/Outras Entidades", "Transf. Externas - Convênios C/Outras Entidades"),
    ("LIBERAÇÕES DE CONVÊNIOS", "Liberações De Convênios"),
    ("Bens Imóveis", "Bens Imóveis"),
    ("Bens Móveis", "Bens Móveis"),
    ("Depósitos Judiciais", "Depósitos Judiciais"),
    ("Fundo de Empresas Emergentes", "Fundo De Empresas Emergentes"),
    ("BENS MÓVEIS", "Bens Móveis"),
    ("BENS INTANGÍVEIS", "Bens Intangíveis"),
    ("DEPÓSITOS JUDICIAIS", "Depósitos Judiciais"),
    ("FUNDO M. DE INVEST. EMPRESAS EMERGENTES", "Fundo M. De Invest. Empresas Emergentes"),
]

NATURE_TEXT = "Descricao_Natureza_Orcamentaria"
NATURE_STANDARD = "Descricao_Natureza_Orcamentaria_FINAL"


def nature_names(spark: SparkSession) -> DataFrame:
    """The built-in nature texts as a table (a literal relation, one row per text)."""
    rows = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(s).alias("s")) for t, s in NATURE_NAMES])
    return spark.range(0, 1, 1, 1).select(F.posexplode(rows).alias("linha", "r")).select(
        F.col("r.t").alias(NATURE_TEXT), F.col("r.s").alias(NATURE_STANDARD), "linha"
    )
