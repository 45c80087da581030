"""Receivable instalments with their movement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.functions.joins import skewed_left_join
from saldo.operators.mappings import (
    CANCELLED_STATUS,
    EXCLUDED_CASH_BOX,
    EXCLUDED_DOCUMENT_TYPES,
    EXCLUDED_HISTORY,
    FIRST_DUE_DATE,
    RECEIVABLE_FLAG,
)

# Source column -> output column, where the two differ.
RENAMED = {"numerodocumento": "recibo", "valorop4bx": "txcartao"}
INSTALMENT_COLUMNS = [
    "idlan", "idmov", "numerodocumento", "descstatuslcto", "datavencimento", "idformapagto",
    "descstatuscnab", "descstatusexportcontabilidade", "coddepartamento", "codcxa",
    "descpagarreceber", "codtdo", "datacriacao", "databaixa", "datacancelamento", "historico",
    "valororiginal", "valorbaixado", "valorjuros", "valordesconto", "dataemissao",
    "dataprevbaixa", "codcfo", "valorop4bx", "codautorizacaovenda", "descricao_tipo_pagamento",
    "codeventobaixa", "codccusto",
]


def due_between(instalments: DataFrame, as_of: str, first_due: str = FIRST_DUE_DATE) -> DataFrame:
    """Receivables due from the first date up to the moment of the run."""
    due = F.col("datavencimento").between(
        F.lit(first_due).cast("timestamp"), F.lit(as_of).cast("timestamp")
    )
    return instalments.filter(due & (F.col("pagrec") == RECEIVABLE_FLAG))


def receivables_filters(
    instalments: DataFrame,
    document_types: list[str] = EXCLUDED_DOCUMENT_TYPES,
    cash_box: str = EXCLUDED_CASH_BOX,
    history: str = EXCLUDED_HISTORY,
) -> DataFrame:
    """Without reimbursements, one cash box, one history and cancelled entries.

    A NULL in any tested column drops the row, as the comparisons are unknown.
    The exclusions hold without regard to case.
    """
    return instalments.filter(
        ~F.col("codtdo").isin(document_types)
        & ~F.col("codcxa").ilike(cash_box)
        & ~F.col("historico").ilike(history)
        & (F.lower("descstatuslcto") != CANCELLED_STATUS.lower())
    )


def with_movement(instalments: DataFrame, movements: DataFrame) -> DataFrame:
    """Left join on the movement id; the 30 output columns."""
    side = movements.select(F.col("idmov").alias("_idmov"), "valorbrutoorig", "codtmv")
    base = instalments.select(*INSTALMENT_COLUMNS).withColumnsRenamed(RENAMED)
    return skewed_left_join(base, side, {"idmov": "_idmov"}, unique=True).drop("_idmov")


def receivables(
    instalments: DataFrame,
    movements: DataFrame,
    as_of: str,
    first_due: str = FIRST_DUE_DATE,
) -> DataFrame:
    """The delinquency base: filters first, then the movement join."""
    kept = receivables_filters(due_between(instalments, as_of, first_due))
    return with_movement(kept, movements)
