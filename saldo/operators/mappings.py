"""Codes, labels and column names that results depend on.

Everything in this module is plain data, stated as is. ``{entity}`` stands for
the name of the organisation whose books are read; pass it to the functions at
the end. Long lists (account allow-list, cost-centre years) are not here: they
are tables of the deployment, read with ``saldo.sources.relational``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Account code, first 4 levels -> category.
CATEGORIES = {
    "6.1.1.1": "Contribuição para o {entity} (CSO)",
    "6.1.2.1": "Contribuição Social do {entity}/NA  (CSN)",
    "6.1.2.2": "CSN Proposta",
    "6.2.1.3": "Aplicações Financeiras",
    "6.2.1.2": "Empresas Beneficiadas",
    "6.1.3.2": "Contrato Interno com {entity}/NA",
    "6.2.1.1": "Convênios, Subvenções e Auxílios",
    "6.2.1.4": "Outras Receitas",
    "6.3.1.1": "Alienação de Bens",
    "6.9.1.1": "Saldo Financ. Exerc. Anterior",
    "3.1.1.1": "Pessoal",
    "3.1.1.2": "Encargos Sociais",
    "3.1.1.3": "Benefícios Sociais",
    "3.1.2.1": "Serviços Especializados",
    "3.1.2.2": "Serviços Contratados",
    "3.1.2.3": "Encargos Sociais s/Serviços de Terceiros",
    "3.1.3.1": "Despesas com Viagens",
    "3.1.3.2": "Aluguéis e Encargos",
    "3.1.3.3": "Divulgação, Anúncios, Publicidade e Propaganda",
    "3.1.3.4": "Serviços Gráficos e de Reprodução",
    "3.1.3.5": "Serviços de Comunicação em Geral",
    "3.1.3.6": "Materiais de Consumo",
    "3.1.3.7": "Demais Custos e Despesas Gerais",
    "3.1.3.8": "Doações e Subvenções",
    "3.1.4.1": "Despesas Tributárias",
    "3.1.4.2": "Despesas Financeiras",
    "3.1.5.3": "Transf. Externas - Convênios c/Outras Entidades",
    "5.1.2.1": "Bens Imóveis",
    "5.1.2.2": "Bens Móveis",
    "5.1.2.3": "Bens Intangíveis",
    "5.1.5.2": "Fundo de Empresas Emergentes",
    "5.1.5.3": "Microcrédito",
    "5.1.4.1": "Depósitos Judiciais",
}

# National revenue code -> full account codes reported under it.
NATIONAL_CODES = {
    "6.1.1.1": [
        "4.1.1.1.01.001", "4.1.1.1.01.002", "4.1.1.1.01.003", "4.1.1.1.01.004",
        "4.1.1.1.01.005", "4.1.1.1.01.006", "4.1.1.1.01.999", "4.1.1.1.02.001",
    ],
    "6.1.2.1": ["4.1.1.2.01.001"],
    "6.1.2.4": ["4.1.1.2.01.002"],
    "6.2.1.1": ["4.1.3.1.01.001", "6.1.1.1.01.001"],
    "6.2.1.2": [
        "4.1.2.1.01.001", "4.1.2.1.01.002", "4.1.2.1.01.003", "4.1.2.1.01.004",
        "4.1.2.1.01.005", "4.1.2.1.01.006", "4.1.2.1.01.007", "4.1.2.1.01.008",
        "4.1.2.1.01.009", "4.1.2.1.01.010", "4.1.2.1.01.011", "4.1.2.1.01.012",
        "4.1.2.1.01.013", "4.1.2.1.01.014", "4.1.2.1.01.998", "4.1.2.1.01.999",
    ],
    "6.2.1.3": [
        "4.1.4.1.01.001", "4.1.4.6.01.001", "4.1.4.6.01.002", "4.1.4.6.01.003",
        "4.1.4.6.01.004", "4.1.4.6.01.005", "4.1.4.6.01.006",
    ],
    "6.2.1.4": [
        "4.1.5.1.01.003", "4.1.5.3.01.001", "4.1.5.3.01.002", "4.1.5.3.01.007",
        "4.1.5.3.01.008", "4.1.5.3.01.999", "6.2.2.1.01.001", "6.2.4.1.01.001",
    ],
    "6.1.3.2": ["4.1.3.2.01.001", "4.1.3.2.02.001"],
    "6.1.2.3": ["4.1.1.6.01.001", "4.1.1.6.01.002"],
    "6.3.1.1": ["4.1.5.4.01.001", "4.1.5.4.02.001", "4.1.5.4.03.001"],
}

# Ledger account, first 4 levels -> budget nature code.
ACCOUNT_RECODES = {
    "5.1.1.2": "5.1.1.1",
    "5.2.1.1": "5.1.1.1",
    "5.2.2.1": "5.1.2.1",
    "5.2.2.2": "5.1.2.2",
    "5.2.3.1": "5.1.2.1",
    "5.2.4.1": "5.1.4.1",
    "5.2.5.2": "5.1.5.2",
    "5.2.5.3": "5.1.5.2",
}

# Fixed values: (ledger account, ledger description) -> budget nature description.
NATURE_LABELS = {
    ("5.1.1.2", "LIBERAÇÕES DE CONVÊNIOS"): "INVESTIMENTOS",
    ("5.2.1.1", "PARTICIPAÇÃO EM OUTRAS ENTIDADES"): "INVESTIMENTOS",
    ("5.2.2.1", "BENS IMÓVEIS"): "BENS IMÓVEIS",
    ("5.2.2.2", "BENS MÓVEIS"): "BENS MÓVEIS",
    ("5.2.3.1", "BENS INTANGÍVEIS"): "BENS IMÓVEIS",
    ("5.2.4.1", "DEPÓSITOS JUDICIAIS"): "DEPÓSITOS JUDICIAIS",
    ("5.2.5.2", "FUNDO M. DE INVEST. EMPRESAS EMERGENTES"): "FUNDO DE EMPRESAS EMERGENTES",
    ("5.2.5.3", "GESTÃO DE FUNDOS E PROGRAMA DE CRÉDITOS"): "FUNDO DE EMPRESAS EMERGENTES",
    ("3.1.2.1", "SERVIÇOS ESPECIALIZADOS - PJ"): "SERVIÇOS ESPECIALIZADOS",
    ("3.1.2.2", "SERVIÇOS CONTRATADOS - PJ"): "SERVIÇOS CONTRATADOS",
    ("3.1.3.1", "DESPESAS COM VIAGENS E LOCOMOÇÃO"): "DESPESAS COM VIAGENS",
    ("3.1.3.2", "ALUGUÉIS E ENCARGOS - PESSOA JURÍDICA (PJ)"): "ALUGUÉIS E ENCARGOS",
    ("3.1.3.7", "DEMAIS CUSTOS E DESPESAS GERAIS - PJ"): "DEMAIS CUSTOS E DESPESAS GERAIS",
}

# Budget plan read for each year.
PLAN_LABELS = {2025: "PPA 2025 - 2025/Mar", 2026: "PPA 2026 - 2026/Mar"}

# Level-1 descriptions that count as expense in the plan report.
EXPENSE_GROUPS = ["DESPESAS", "DESPESAS EXCLUSIVAS DO ORÇAMENTO"]

# Level-3 descriptions that count as revenue in the coverage report.
REVENUE_GROUPS = [
    "RECEITAS DE EMPRESAS BENEFICIADAS",
    "RECEITAS DE CONVÊNIOS, SUBVENÇÕES E AUXÍLIOS",
]

# History codes left out of the ledger, first ledger year.
EXCLUDED_HISTORY_CODES = [820, 104, 98, 94, 96, 821]
FIRST_LEDGER_YEAR = 2022

# Receivables left out of the delinquency base.
EXCLUDED_DOCUMENT_TYPES = ["030"]
EXCLUDED_CASH_BOX = "22.420-0"
EXCLUDED_HISTORY = "Dev. adiantamento  viagem"
CANCELLED_STATUS = "Cancelado"
RECEIVABLE_FLAG = "1"
FIRST_DUE_DATE = "2025-01-01"

# Project name to correct -> name used by the budget.
PROJECT_CORRECTIONS = {
    "{entity} Aqui - Inaugurações e Revitalizações": "{entity} Aqui - Inauguração e Revitalização",
}
CANCELLED_INITIATIVE = "CANCELADO%"

# Movement types treated as outliers.
OUTLIER_CHANNELS = ["2.1.13", "2.1.13.0"]

# Fund report type and heading.
FUND_REPORT_TYPE = "Informe Mensal Estruturado"
FUND_TABLE_HEADING = "V - Comportamento da Carteira"

# Month names of the dashboard.
MONTH_NAMES = {
    1: "Janeiro", 2: "Fevereiro", 3: "Março", 4: "Abril", 5: "Maio", 6: "Junho",
    7: "Julho", 8: "Agosto", 9: "Setembro", 10: "Outubro", 11: "Novembro", 12: "Dezembro",
}

# Lower-cased source column name -> standard column name.
COLUMN_NAMES = {
    "[ppa].[ppa com fotografia].[descrição de ppa com fotografia].[member_caption]": "nm_ppa",
    "[unidade organizacional de iniciativa].[unidade organizacional de iniciativa].[nome de unidade organizacional de iniciativa].[member_caption]": "nm_unidade",
    "[natureza orçamentária].[código estruturado 4 nível].[código estruturado 4 nível].[member_caption]": "cdg_natOrcamentoNvl4",
    "[natureza orçamentária].[descrição de natureza 4 nível].[descrição de natureza 4 nível].[member_caption]": "nm_natOrcamentoNvl4",
    "[iniciativa].[iniciativas].[iniciativa].[member_caption]": "nm_iniciativa",
    "[unidade organizacional de ação].[unidade organizacional de ação].[nome de unidade organizacional de ação].[member_caption]": "nm_unidade",
    "[ação].[ação].[nome de ação].[member_caption]": "nm_acao",
    "[tempo].[ano].[número ano].[member_caption]": "vl_ano",
    "[tempo].[mês].[número mês].[member_caption]": "vl_mes",
    "[measures].[valorajustado]": "vl_ajustado",
    "cc": "nm_cc",
    "dataemissao": "nm_dataemissao",
    "categoria": "nm_categoria",
    "conta": "nm_conta",
    "complemento": "nm_complemento",
    "cdgcontanvl4": "nm_cdgOrcamentoNvl4",
    "valor": "vl_valor",
    "data": "nm_data",
    "nacional": "nm_nacional",
    "idrateio": "cdg_idrateio",
    "lctref": "cdg_referencia",
    "idpartida": "cdg_idpartida",
    "idmov": "cdg_idmov",
    "codtmv": "cdg_codtmv",
    "contrato": "cdg_contrato",
    "fornecedor": "nm_fornecedor",
    "codusuario": "nm_codusuario",
    "tipolancamento": "nm_tipolancamento",
    "acao": "nm_acao",
    "projeto": "nm_projeto",
    "unidade": "nm_unidade",
    "descnvl6": "nm_descnvl6",
    "descnvl5": "nm_descnvl5",
    "descnvl4": "nm_descnvl4",
    "descnvl3": "nm_descnvl3",
    "descnvl2": "nm_descnvl2",
    "descnvl1": "nm_descnvl1",
    "descricao": "nm_descricao",
    "valor_str": "vl_valor_str",
    "nm_ppa": "nm_ppa",
    "nm_unidade": "nm_unidade",
    "nm_iniciativa": "nm_iniciativa",
    "nm_acao": "nm_acao",
    "cdg_natorcamentonvl4": "cdg_natorcamentonvl4",
    "nm_natorcamentonvl4": "nm_natorcamentonvl4",
    "vl_ano": "vl_ano",
    "vl_mes": "vl_mes",
    "vl_ajustado": "vl_ajustado",
    "idlan": "cdg_idlan",
    "recibo": "nm_recibo",
    "descstatuslcto": "nm_descstatuslcto",
    "datavencimento": "dt_datavencimento",
    "idformapagto": "cdg_idformapagto",
    "descstatuscnab": "nm_descstatuscnab",
    "descstatusexportcontabilidade": "nm_descstatusexportcontabilidade",
    "coddepartamento": "cdg_coddepartamento",
    "codcxa": "cdg_codcxa",
    "descpagarreceber": "nm_descpagarreceber",
    "codtdo": "cdg_codtdo",
    "datacriacao": "dt_datacriacao",
    "databaixa": "dt_databaixa",
    "datacancelamento": "dt_datacancelamento",
    "historico": "nm_historico",
    "valororiginal": "vl_valororiginal",
    "valorbaixado": "vl_valorbaixado",
    "valorjuros": "vl_valorjuros",
    "valordesconto": "vl_valordesconto",
    "dataprevbaixa": "dt_dataprevbaixa",
    "codcfo": "cdg_codcfo",
    "txcartao": "vl_txcartao",
    "codautorizacaovenda": "nm_codautorizacaovenda",
    "descricao_tipo_pagamento": "nm_descricao_tipo_pagamento",
    "codeventobaixa": "cdg_codeventobaixa",
    "codccusto": "cdg_codccusto",
    "id_meta": "id_meta",
    "dt_contabil": "dt_contabil",
    "cd_referencia": "cd_referencia",
    "cd_partida": "cd_partida",
    "nm_local_estoque_faturamento": "nm_local_estoque_faturamento",
    "nm_local_estoque": "nm_local_estoque",
    "nm_unidade_tratada": "nm_unidade_tratada",
    "vl_receita_bruta": "vl_receita_bruta",
    "vl_inadimplencia_gerada": "vl_inadimplencia_gerada",
    "vl_inadimplencia_recuperada": "vl_inadimplencia_recuperada",
    "vl_receita_futura": "vl_receita_futura",
    "vl_bolsa": "vl_bolsa",
    "cd_cfo": "cd_cfo",
    "cd_cpf_cnpj": "cd_cpf_cnpj",
    "cd_produto": "cd_produto",
    "nm_produto": "nm_produto",
    "cd_centro_custo": "cd_centro_custo",
    "cd_plano": "cd_plano",
    "nm_plano": "nm_plano",
    "cd_acao": "cd_acao",
    "cd_unidade_rm": "cd_unidade_rm",
    "nm_unidaderm": "nm_unidaderm",
    "grandes_contratos": "grandes_contratos",
    "cd_cfoaluno": "cd_cfoaluno",
    "linha": "linha",
    "ano": "ano",
    "valorbrutoorig": "vl_bruto",
    "[natureza contábil].[código natureza contábil grupo 6].[código natureza contábil].[member_caption]": "cdg_cdgnvl6",
    "[natureza contábil].[descrição natureza contábil grupo 6].[natureza contábil].[member_caption]": "nm_descnvl6",
    "[measures].[valorexecutado]": "vl_contabilExecutado",
    "[fotografia].[fotografia].[fotografia].[member_caption]": "nm_ppafoto",
    "[measures].[vl_receita_executado]": "vl_receitaExecutado",
    "[ação].[ação].[ação].[member_caption]": "nm_acao",
    "[natureza orçamentária].[código natureza orçamentária grupo 4].[código natureza orçamentária].[member_caption]": "nm_cdgNatureza",
    "[projetos processos].[nome projeto e processo].[projeto e processo].[member_caption]": "nm_iniciativa",
    "[unidade organizacional de ação].[unidade organizacional de ação].[unidade organizacional de ação].[member_caption]": "nm_UnidadeAcao",
    "[ação].[códgio rm].[código rm].[member_caption]": "cdg_RM",
    "[natureza orçamentária].[descrição natureza orçamentária grupo 4].[natureza orçamentária].[member_caption]": "nm_descnvl4",
    "[measures].[vl_despesa_executado]": "vl_despesaExecutado",
    "[unidade organizacional de projeto e processo].[unidade organizacional de projeto e processo].[unidade organizacional de projeto e processo].[member_caption]": "nm_unidadeIniciativa",
    "[tempo].[mês].[mês].[member_caption]": "nm_mes",
    "[tempo].[ano].[ano].[member_caption]": "nm_ano",
}

# Display names of the delinquency tables.
IMPACT_NAMES = {
    "ano_venc": "Ano Vencimento",
    "cdg_codtmv": "Canal (CODTMV)",
    "valor_total_em_aberto": "Valor Total Acumulado em Aberto (R$)",
    "maior_boleto_individual": "Maior Boleto Único do Canal (R$)",
    "quantidade_de_parcelas": "Qtd Parcelas Vencidas",
}
TOP_OPEN_NAMES = {
    "cdg_idmov": "ID da Fatura (IDMOV)",
    "cdg_codtmv": "Canal (CODTMV)",
    "dt_datavencimento": "Data Vencimento",
    "vl_bruto": "Valor Total da Fatura (IDMOV)",
    "vl_valororiginal": "Valor desta Parcela (Individual)",
    "nm_descstatuslcto": "Status Original",
    "nm_historico": "Histórico Lançamento",
}
AUDIT_NAMES = {
    "dt_datavencimento": "Data Vencimento",
    "dt_databaixa": "Data Baixa",
    "vl_bruto": "Valor Total da Fatura (IDMOV)",
    "vl_valororiginal": "Valor desta Parcela (Individual)",
    "cdg_codtmv": "Tipo Movimento",
    "nm_descstatuslcto": "Status Lançamento",
    "status_simplificado": "Status Simplificado",
    "nm_historico": "Histórico",
}

# Cash behaviour classes.
PAID_ON_TIME = "Baixado em Dia (No Prazo)"
PAID_LATE = "Baixado em Atraso (Recuperado)"
STILL_OPEN = "Em Aberto Atualmente (Sem Baixa)"
PAID, OPEN = "Baixado", "Em Aberto"


def fixed_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small inline table; Spark knows its exact size, so joins broadcast it."""
    width = len(names)
    marks = ", ".join(
        "(" + ", ".join(f":v{n * width + i}" for i in range(width)) + ")" for n in range(len(rows))
    )
    values = {f"v{n}": value for n, value in enumerate(v for row in rows for v in row)}
    return spark.sql(f"select * from values {marks} as t({', '.join(names)})", args=values)


def category_table(spark: SparkSession, entity: str) -> DataFrame:
    """(prefixo, categoria) with the organisation's name filled in."""
    rows = [(code, label.format(entity=entity)) for code, label in CATEGORIES.items()]
    return fixed_table(spark, rows, ["prefixo", "categoria"])


def national_table(spark: SparkSession) -> DataFrame:
    """(codconta, nacional), one row per listed account."""
    rows = [(account, code) for code, accounts in NATIONAL_CODES.items() for account in accounts]
    return fixed_table(spark, rows, ["codconta", "nacional"])


def recode_table(spark: SparkSession) -> DataFrame:
    """(prefixo, natureza) for the plan report."""
    return fixed_table(spark, list(ACCOUNT_RECODES.items()), ["prefixo", "natureza"])


def label_table(spark: SparkSession) -> DataFrame:
    """(prefixo, descricao, rotulo) for the plan report."""
    rows = [(code, text, label) for (code, text), label in NATURE_LABELS.items()]
    return fixed_table(spark, rows, ["prefixo", "descricao", "rotulo"])


def project_corrections(entity: str) -> dict[str, str]:
    """Project names to correct, with the organisation's name filled in."""
    return {a.format(entity=entity): b.format(entity=entity) for a, b in PROJECT_CORRECTIONS.items()}
