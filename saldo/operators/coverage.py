"""Coverage of expenses by own revenue, and load telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.functions.dates import in_years
from saldo.functions.numbers import REPORT_MONEY
from saldo.functions.text import fold_case, folded_in
from saldo.operators.mappings import REVENUE_GROUPS


def coverage(
    fact: DataFrame,
    years: list[int],
    last_month: int = 3,
    expense_pattern: str = "desp%",
    revenue_groups: list[str] = REVENUE_GROUPS,
) -> DataFrame:
    """Expense, revenue, net result and coverage percent by unit and year.

    One scan, and one shuffle of sums by spelling: a row counts as expense, revenue, both or
    neither. Units compare without case and trailing blanks and show their
    smallest spelling. Rows without a unit keep expense and revenue apart, since a
    missing unit never equals another.
    """
    rows = fact.filter(in_years("nm_data", years, last_month))
    amount = F.col("vl_valor").try_cast(REPORT_MONEY)
    expense = F.when(F.col("nm_descnvl1").ilike(expense_pattern), F.lit("D"))
    revenue = F.when(folded_in("nm_descnvl3", revenue_groups), F.lit("R"))
    kinds = rows.select(
        "nm_unidade",
        F.year("nm_data").alias("ano"),
        amount.alias("valor"),
        F.explode(F.array_compact(F.array(expense, revenue))).alias("tipo"),
    )
    apart = F.when(F.col("nm_unidade").isNull(), F.col("tipo"))
    zero = F.lit(0).cast(REPORT_MONEY)
    # by spelling first: looking for the smallest one makes Spark sort what it groups
    spelt = kinds.groupBy("nm_unidade", "ano", "tipo").agg(F.sum("valor").alias("valor"))
    sums = spelt.groupBy(fold_case("nm_unidade").alias("_unidade"), "ano", apart.alias("_tipo")).agg(
        F.min("nm_unidade").alias("nm_unidade"),
        F.coalesce(F.sum(F.when(F.col("tipo") == "D", F.col("valor"))), zero).alias("despesa"),
        F.coalesce(F.sum(F.when(F.col("tipo") == "R", F.col("valor"))), zero).alias("receita"),
    )
    spent, earned = F.col("despesa").cast("double"), F.col("receita").cast("double")
    return sums.select(
        F.trim("nm_unidade").alias("unidade"),
        "ano",
        spent.alias("despesa"),
        earned.alias("receita"),
        (F.col("receita") - F.col("despesa")).cast("double").alias("resultado_liquido"),
        F.when(F.col("despesa") > 0, earned / spent * 100)
        .otherwise(F.lit(0.0))
        .alias("indice_cobertura"),
    ).orderBy("unidade", "ano")


#: Metric name to its path in the audit details and its type.
METRIC_PATHS = {
    "linhas": ("$.kpis_gerais.total_linhas", "bigint"),
    "colunas": ("$.kpis_gerais.total_colunas", "int"),
    "nulos": ("$.qualidade_dados.total_nulos", "bigint"),
    "soma_faixas": ("$.kpis_gerais.soma_total", "double"),
}
STATISTIC_PATHS = ["soma_total", "media", "maximo", "minimo"]


def parsed_details(audit: DataFrame) -> DataFrame:
    """The audit rows with their details parsed, as a VARIANT column ``detalhes``.

    Rows stored with the column keep it; others are parsed from their text. What is no JSON,
    or is missing, becomes the empty object.
    """
    text = F.coalesce(F.try_parse_json("detalhes_json"), F.parse_json(F.lit("{}")))
    found = F.coalesce("detalhes", text) if "detalhes" in audit.columns else text
    return audit.withColumn("detalhes", found).drop("detalhes_json")


def telemetry_metrics(audit: DataFrame) -> DataFrame:
    """Each refresh with its metrics as typed columns; what the details lack, or hold in another type, is NULL."""
    parsed = parsed_details(audit)
    metrics = [F.try_variant_get("detalhes", path, kind).alias(name) for name, (path, kind) in METRIC_PATHS.items()]
    return parsed.select("nome_processo", "data_execucao", *metrics)


def telemetry_statistics(audit: DataFrame) -> DataFrame:
    """(nome_processo, data_execucao, coluna, soma_total, media, maximo, minimo): the measured columns of each refresh."""
    parsed = parsed_details(audit)
    # looked up as an object, so that a text or a number there has no columns
    columns = F.try_variant_get("detalhes", "$.estatisticas_numericas", "map<string,variant>")
    each = parsed.select("nome_processo", "data_execucao", F.explode(columns).alias("coluna", "_valores"))
    values = [F.try_variant_get("_valores", f"$.{name}", "double").alias(name) for name in STATISTIC_PATHS]
    return each.select("nome_processo", "data_execucao", "coluna", *values)


def telemetry_schema(audit: DataFrame) -> DataFrame:
    """(nome_processo, esquema): the common schema of each dataset's details."""
    return parsed_details(audit).groupBy("nome_processo").agg(F.schema_of_variant_agg("detalhes").alias("esquema"))


def telemetry(audit: DataFrame) -> DataFrame:
    """Audit rows, newest first; details that are no JSON become ``{}``."""
    readable = F.try_parse_json("detalhes_json").isNotNull()
    return audit.select(
        "nome_processo",
        F.date_format("data_execucao", "yyyy-MM-dd HH:mm:ss").alias("data_execucao"),
        F.col("total_linhas").cast("bigint").alias("total_linhas"),
        F.col("total_colunas").cast("int").alias("total_colunas"),
        F.col("total_nulos").cast("bigint").alias("total_nulos"),
        F.when(readable, F.col("detalhes_json")).otherwise(F.lit("{}")).alias("detalhes"),
    ).orderBy(F.desc("data_execucao"))
