"""The column rules as SQL functions, and the reports that can be written with them.

``register`` makes the functions known to a session. They are expressions, which the
analyser puts in place of each call, so a report through ``spark.sql`` is planned like
one written with the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saldo.functions.joins import small_copy
from saldo.operators.mappings import OPEN, PAID, PAID_LATE, PAID_ON_TIME, STILL_OPEN

#: Function heads and bodies.
RULES = {
    "saldo_chave(texto STRING) RETURNS STRING": "rtrim(upper(texto))",
    "saldo_prefixo(conta STRING) RETURNS STRING": "left(conta, 7)",
    "saldo_corte(ano INT, ano_antigo INT, agora TIMESTAMP) RETURNS TIMESTAMP":
        "CASE WHEN ano = ano_antigo THEN agora - INTERVAL 1 YEAR ELSE agora END",
    "saldo_atrasado(vencimento TIMESTAMP, baixa TIMESTAMP, limite TIMESTAMP) RETURNS BOOLEAN":
        "coalesce(baixa > vencimento, false) OR coalesce(baixa IS NULL AND vencimento < limite, false)",
    "saldo_situacao(situacao STRING, baixa TIMESTAMP, limite TIMESTAMP) RETURNS STRING":
        f"CASE WHEN lower(trim(situacao)) = '{PAID.lower()}' AND baixa <= limite THEN '{PAID}' ELSE '{OPEN}' END",
    "saldo_pagamento(vencimento TIMESTAMP, baixa TIMESTAMP) RETURNS STRING":
        f"CASE WHEN baixa <= vencimento THEN '{PAID_ON_TIME}' WHEN baixa > vencimento THEN '{PAID_LATE}' ELSE '{STILL_OPEN}' END",
}

RECODE = """
    SELECT f.nm_conta, coalesce(c.natureza, saldo_prefixo(f.nm_conta)) AS cdg_natorcamentonvl4,
           coalesce(r.rotulo, f.nm_descnvl4) AS nm_descnvl4, f.vl_valor
    FROM {fact} f
    LEFT JOIN {codes} c ON saldo_prefixo(f.nm_conta) = c.prefixo
    LEFT JOIN {labels} r ON saldo_prefixo(f.nm_conta) = r.prefixo AND saldo_chave(f.nm_descnvl4) = saldo_chave(r.descricao)"""

FLAGS = """
    SELECT *, saldo_atrasado(dt_datavencimento, dt_databaixa, data_limite_corte) AS is_inadimplente,
           saldo_situacao(nm_descstatuslcto, dt_databaixa, data_limite_corte) AS status_simplificado
    FROM (SELECT *, saldo_corte(ano_venc, {old}, CAST({now} AS TIMESTAMP)) AS data_limite_corte FROM {base})"""

TIMELINE = f"""
    SELECT ano_venc * 100 + mes_venc AS periodo_ordenado, concat(mes_venc, '/', ano_venc) AS periodo_nome,
           {", ".join(f"coalesce(sum(vl_valororiginal) FILTER (WHERE saldo_pagamento(dt_datavencimento, dt_databaixa) = '{c}'), 0) AS `{c}`" for c in (PAID_ON_TIME, PAID_LATE, STILL_OPEN))}
    FROM {{base}} GROUP BY ALL ORDER BY periodo_ordenado"""


def register(spark: SparkSession) -> list[str]:
    """Creates the functions in the session and returns their names."""
    for head, body in RULES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in RULES]


def recode_account(fact: DataFrame, codes: DataFrame, labels: DataFrame) -> DataFrame:
    """Account, nature code, description and amount; ``planactual.recode_account`` in SQL."""
    spark = fact.sparkSession
    register(spark)
    known = {name: small_copy(table) for name, table in (("codes", codes), ("labels", labels))}
    tables = {name: table.hint("broadcast") for name, table in known.items() if table is not None}
    return spark.sql(RECODE, fact=fact, **({"codes": codes, "labels": labels} | tables))


def delinq_flags(base: DataFrame, as_of: str, old_year: int) -> DataFrame:
    """``delinquency.delinq_flags`` in SQL."""
    register(base.sparkSession)
    return base.sparkSession.sql(FLAGS, base=base, old=old_year, now=as_of)


def cash_timeline(base: DataFrame) -> DataFrame:
    """``delinquency.cash_timeline`` in SQL."""
    register(base.sparkSession)
    return base.sparkSession.sql(TIMELINE, base=base)
