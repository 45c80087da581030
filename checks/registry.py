"""One Spark query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import AS_OF, FIRST_DUE, LAST_MONTH, NEW, OLD, PLANS, base_table, view
from saldo.functions.text import collation_key, local_number, spelled
from saldo.operators import (
    budget,
    coverage,
    dashboard,
    delinquency,
    hierarchy,
    ledger,
    mappings,
    planactual,
    quality,
    receivables,
    standardize,
    study,
)
from saldo.plans import datasets, reports, sqlrules
from saldo.plans.refresh import checked, refresh_all, standardized
from saldo.session import ensure_checkpoint_dir, work_path
from saldo.sources import cubes, funds, relational, tables

Query = Callable[[SparkSession, str], DataFrame]
ENTITY = "Entidade"
CUBE_ENTITY = "EUROPE"
FIRST_CUBE, LAST_CUBE = 199603, 200010
CORRECTIONS = {"middle east": "Oriente Médio"}
CHANNELS = [f"2.1.{n}" for n in range(1, 4)]
RUN_AT = "2000-07-01 06:30:00"
REVENUES = ["REC A", "REC B"]

_registered: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _registered[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    """Registered queries by name."""
    return dict(_registered)


# --- sources -----------------------------------------------------------------


@_query
def scan_project(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag"]
    return relational.scan_project(spark, f"{sf}/lineitem.parquet", columns)


@_query
def account_allowlist(spark, sf):
    lines = view(spark, sf, "fx_journal")
    return ledger.keep_listed(ledger.split_legs(lines), view(spark, sf, "fx_allowlist")).select(
        "lctref", "idpartida", "conta", "tipolancamento", "valor"
    )


def _documents(spark, sf):
    price = F.col("p_retailprice").cast("decimal(18,2)")
    whole = F.floor(price).cast("int")
    local = F.concat(
        F.floor(whole / 1000).cast("string"), F.lit("."),
        F.lpad((whole % 1000).cast("string"), 3, "0"), F.lit(","),
        F.lpad(((price * 100).cast("bigint") % 100).cast("string"), 2, "0"),
    )
    page = F.concat(
        F.lit("<html><body><table><tr><td>menu</td></tr></table><table><tr><td colspan='2'>"),
        F.lit("<b>Tabela V - Comportamento da Carteira</b></td></tr><tr><td> a.1) "), F.col("p_name"),
        F.lit(" &amp; outros</td><td><span class='dado-valores'> R$ "), local,
        F.lit("</span></td></tr><tr><td>b.1) "), F.col("p_brand"), F.lit("</td><td>-</td></tr></table>"),
    )
    parts = base_table(spark, sf, "part")
    return parts.select(
        F.col("p_partkey").alias("id"),
        F.col("p_size").cast("string").alias("fundo"),
        F.when(F.col("p_partkey") % 2 == 0, "Informe Mensal Estruturado ").otherwise("Outro").alias("tipo_documento"),
        F.concat(F.lpad((F.col("p_partkey") % 12 + 1).cast("string"), 2, "0"), F.lit("/2000")).alias("data_referencia"),
        F.base64(page.cast("binary")).alias("content"),
    )


@_query
def fund_doc_select(spark, sf):
    return funds.select_fund_documents(_documents(spark, sf))


@_query
def fund_doc_wanted(spark, sf):
    found = _documents(spark, sf)
    wanted = found.filter((F.col("id") % 6 == 0)).select("fundo", "data_referencia")
    nobody = spark.range(1).select(F.lit("nenhum").alias("fundo"), F.lit("01/2000").alias("data_referencia"))
    wanted = wanted.unionByName(nobody)
    required = found.filter(F.col("id") % 10 == 0).select("fundo", "data_referencia")
    optional = funds.select_fund_documents(found, wanted).withColumn("lista", F.lit("opcional"))
    return optional.unionByName(
        funds.select_fund_documents(found, required, required=True).withColumn("lista", F.lit("exigido"))
    )


@_query
def fund_table_extract(spark, sf):
    return funds.fund_table_extract(_documents(spark, sf))


CUBES = {
    "cube_budget_expense": (cubes.BUDGET_EXPENSE, "vl_ajustado"),
    "cube_executed_expense": (cubes.EXECUTED_EXPENSE, "m_executado"),
    "cube_executed_entities": (cubes.EXECUTED_ENTITIES, "m_entidades"),
    "cube_revenue_initiative": (cubes.REVENUE_INITIATIVE, "m_receita"),
    "cube_revenue_scenario": (cubes.REVENUE_SCENARIO, "m_cenario"),
    "cube_account_balance": (cubes.ACCOUNT_BALANCE, "m_contabil"),
    "cube_expense_snapshot": (cubes.EXPENSE_SNAPSHOT, "m_foto_despesa"),
    "cube_revenue_snapshot": (cubes.REVENUE_SNAPSHOT, "m_foto_receita"),
}


def _cube(name: str, slice_: cubes.Slice, measure: str) -> None:
    def run(spark, sf):
        entity = CUBE_ENTITY if slice_.one_entity else None
        return slice_.read(view(spark, sf, "fx_cube"), measure, entity, FIRST_CUBE, LAST_CUBE)

    _registered[name] = run


for _name, (_slice, _measure) in CUBES.items():
    _cube(_name, _slice, _measure)


@_query
def cube_slices(spark, sf):
    readings = {n: cubes.Reading(s, m, CUBE_ENTITY, FIRST_CUBE, LAST_CUBE) for n, (s, m) in CUBES.items()}
    return cubes.cube_slices(view(spark, sf, "fx_cube"), readings)


# --- ledger ------------------------------------------------------------------


@_query
def account_category(spark, sf):
    categories = mappings.category_table(spark, ENTITY)
    return hierarchy.account_category(view(spark, sf, "fx_account"), categories).select(
        "codconta", "categoria", "receita_despesa"
    )


@_query
def account_hierarchy(spark, sf):
    return hierarchy.account_hierarchy(
        view(spark, sf, "fx_account"), mappings.category_table(spark, ENTITY)
    )


@_query
def cost_center_hierarchy(spark, sf):
    return hierarchy.cost_center_hierarchy(view(spark, sf, "fx_cost_center"))


@_query
def concat_key(spark, sf):
    return hierarchy.concat_key(hierarchy.cost_center_hierarchy(view(spark, sf, "fx_cost_center"))).select("cc", "chave_concat")


def _pinned(spark, sf, name):
    """A reference view computed once, as a deployment would have it stored."""
    ensure_checkpoint_dir(spark)
    return view(spark, sf, name).checkpoint()


def _legs(spark, sf, accounts=None, allowlist=None):
    return ledger.ledger_legs(
        view(spark, sf, "fx_journal"),
        view(spark, sf, "fx_allocation"),
        view(spark, sf, "fx_movement"),
        view(spark, sf, "fx_counterparty"),
        accounts or view(spark, sf, "fx_account"),
        allowlist,
        first_year=OLD,
    )


def _buckets(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@_query
def ledger_legs_bucketed(spark, sf):
    """The legs with the movements stored in buckets of the key that journal lines name."""
    keyed = ledger.with_movement_key(view(spark, sf, "fx_movement"))
    stored = tables.store_bucketed(keyed, "movimentos por chave", ledger.MOVEMENT_KEY, _buckets(spark))
    return ledger.ledger_legs(
        view(spark, sf, "fx_journal"), view(spark, sf, "fx_allocation"), stored, view(spark, sf, "fx_counterparty"),
        view(spark, sf, "fx_account"), first_year=OLD,
    )


@_query
def ledger_filters(spark, sf):
    return ledger.ledger_filters(view(spark, sf, "fx_journal"), first_year=OLD).select(
        "lctref", "idpartida", "data", "codhistp", "valor"
    )


@_query
def ledger_value_rule(spark, sf):
    lines = view(spark, sf, "fx_journal").withColumnRenamed("valor", "valor_lancado")
    legs = ledger.split_legs(lines).join(
        view(spark, sf, "fx_account").select(F.col("codconta").alias("conta"), "natureza"), "conta"
    )
    legs = ledger.attach_allocations(legs, view(spark, sf, "fx_allocation"))
    return ledger.ledger_value_rule(legs).select(
        "lctref", "idpartida", "tipolancamento", "idrateio", "conta", "natureza", "valor"
    )


@_query
def ledger_legs(spark, sf):
    return _legs(spark, sf)


@_query
def national_code(spark, sf):
    legs = ledger.split_legs(view(spark, sf, "fx_journal"))
    return ledger.national_code(legs, view(spark, sf, "fx_national")).select(
        "lctref", "idpartida", "tipolancamento", "conta", "nacional"
    )


@_query
def ledger_fact(spark, sf):
    accounts = _pinned(spark, sf, "fx_account")
    return ledger.ledger_fact(
        _legs(spark, sf, accounts, view(spark, sf, "fx_allowlist")),
        hierarchy.cost_center_hierarchy(_pinned(spark, sf, "fx_cost_center")),
        hierarchy.account_hierarchy(accounts, mappings.category_table(spark, ENTITY)),
        view(spark, sf, "fx_national"),
    )


# --- budget ------------------------------------------------------------------


def _cc_map(spark, sf):
    years = view(spark, sf, "fx_year_map")
    centers = hierarchy.cost_center_hierarchy(_pinned(spark, sf, "fx_cost_center"), CORRECTIONS)
    return budget.budget_cc_map(
        [years.filter(F.col("ano") == str(OLD)), years.filter(F.col("ano") == str(NEW))], centers
    )


@_query
def budget_cc_map(spark, sf):
    return _cc_map(spark, sf)


@_query
def collated_key_join(spark, sf):
    rows = view(spark, sf, "fx_budget")
    key = collation_key(F.col("vl_ano").cast("string"), "nm_iniciativa", "nm_acao", "nm_unidade")
    found = budget.name_keys(_cc_map(spark, sf))
    return (
        rows.withColumn("chave", key)
        .join(found, "chave")
        .groupBy("chave", "nm_cc")
        .agg(F.min(spelled("chave")).alias("menor"), F.count(F.lit(1)).alias("linhas"))
        .select(F.col("menor").alias("chave"), "nm_cc", "linhas")
    )


@_query
def budget_with_cc(spark, sf):
    return budget.budget_with_cc(view(spark, sf, "fx_budget"), _cc_map(spark, sf))


@_query
def plan_filter(spark, sf):
    return budget.plan_filter(view(spark, sf, "fx_plan"), list(PLANS.values()), LAST_MONTH)


# --- receivables -------------------------------------------------------------


@_query
def receivables_base(spark, sf):
    due = receivables.due_between(view(spark, sf, "fx_instalment"), AS_OF, FIRST_DUE)
    return receivables.with_movement(due, view(spark, sf, "fx_movement"))


@_query
def receivables_bucketed(spark, sf):
    """The same join with the movements stored in buckets of their id."""
    stored = tables.store_bucketed(view(spark, sf, "fx_movement"), "movimentos por id", "idmov", _buckets(spark))
    due = receivables.due_between(view(spark, sf, "fx_instalment"), AS_OF, FIRST_DUE)
    return receivables.with_movement(due, stored)


@_query
def receivables_filters(spark, sf):
    return receivables.receivables(
        view(spark, sf, "fx_instalment"), view(spark, sf, "fx_movement"), AS_OF, FIRST_DUE
    )


# --- standardise, quality, tables --------------------------------------------


@_query
def rename_standard(spark, sf):
    return standardize.rename_standard(view(spark, sf, "fx_movement"))


@_query
def rename_fallback(spark, sf):
    orders = base_table(spark, sf, "orders")
    raw = orders.select(
        F.col("o_orderkey").alias(" Valor (R$)"),
        F.col("o_custkey").alias("[Foto].[Foto].[Nome].[MEMBER_CAPTION]"),
        F.col("o_orderstatus").alias("[Key]"),
        F.col("o_orderpriority").alias("Situação do Título"),
    )
    return standardize.rename_standard(raw)


@_query
def br_number_parse(spark, sf):
    return view(spark, sf, "fx_text_amount").select("id", local_number("valor_str").alias("vl_valor"))


@_query
def br_number_column(spark, sf):
    return standardize.parse_value_column(view(spark, sf, "fx_mixed_amount"))


@_query
def decimal_scale(spark, sf):
    return standardize.decimal_scale(view(spark, sf, "fx_typed"))


@_query
def int_columns(spark, sf):
    return standardize.int_columns(view(spark, sf, "fx_period"))


@_query
def quality_metrics(spark, sf):
    return quality.quality_metrics(standardize.standardize(view(spark, sf, "fx_plan")))


@_query
def numeric_stats(spark, sf):
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "vl_preco"]
    lines = base_table(spark, sf, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)").alias("vl_preco")
    return quality.numeric_stats(lines.withColumn("vl_preco", price).select(*columns))


@_query
def fund_kpis(spark, sf):
    return quality.fund_kpis(standardize.standardize(view(spark, sf, "fx_text_amount")))


@_query
def load_replace(spark, sf):
    tables.load_replace(view(spark, sf, "fx_plan"), "plano carga", cluster_by="vl_ano")
    return tables.read_back(spark, "plano carga")


@_query
def read_back(spark, sf):
    tables.load_replace(view(spark, sf, "fx_movement"), "Movimentos Lidos")
    found = tables.read_many(spark, ["Movimentos Lidos", "inexistente"], ["MOVIMENTOS LIDOS", "inexistente"])
    return found["Movimentos Lidos"]


@_query
def read_through(spark, sf):
    def build():
        return view(spark, sf, "fx_year_map").groupBy("ano").agg(F.count(F.lit(1)).alias("centros"))

    tables.read_through(spark, "anos guardados", build, force=True)
    return tables.read_through(spark, "anos guardados", build)


@_query
def audit_append(spark, sf):
    trail = work_path(spark, "auditoria")
    sources = {
        "orcado": lambda: view(spark, sf, "fx_plan"),
        "vazio": lambda: view(spark, sf, "fx_plan").filter("vl_ano < 0"),
        "quebrado": lambda: view(spark, sf, "fx_plan").select("inexistente"),
        "titulos": lambda: view(spark, sf, "fx_text_amount"),
    }
    refresh_all(sources, RUN_AT, trail)
    rows = spark.read.schema(tables.AUDIT_SCHEMA).parquet(trail)
    linhas = F.get_json_object("detalhes_json", "$.kpis_gerais.total_linhas").cast("bigint")
    return rows.select(
        "nome_processo", F.date_format("data_execucao", "yyyy-MM-dd HH:mm:ss").alias("data_execucao"),
        "total_linhas", "total_colunas", "total_nulos", linhas.alias("linhas_json"),
        *[
            F.get_json_object("detalhes_json", path).cast("double").alias(name)
            for name, path in (
                ("soma_anos", "$.estatisticas_numericas.vl_ano.soma_total"),
                ("maximo_ids", "$.estatisticas_numericas.id.maximo"),
                ("soma_faixas", "$.kpis_gerais.soma_total"),
            )
        ],
    )


SOURCES = {
    "CCONTA": "fx_account", "CLANCA": "fx_journal", "CRATEIOLC": "fx_allocation", "TMOV": "fx_movement",
    "FCFO": "fx_counterparty", "GCCUSTO": "fx_cost_center", "ORCADO": "fx_budget", "FLAN": "fx_instalment",
    "CUBO": "fx_cube",
}


@_query
def refresh_dataset(spark, sf):
    def source(name):
        return view(spark, sf, SOURCES[name])

    years = view(spark, sf, "fx_year_map")
    every = {
        "fatofechamento": lambda: datasets.fatofechamento(
            spark, source, ENTITY, view(spark, sf, "fx_allowlist"), OLD, view(spark, sf, "fx_national")
        ),
        "plancc": lambda: datasets.plancc(source, [years], CORRECTIONS),
        "orcado": lambda: datasets.cube_dataset("orcado", source, "vl_ajustado", CUBE_ENTITY, first=FIRST_CUBE, last=LAST_CUBE),
        "inadim": lambda: datasets.inadim(source, AS_OF, FIRST_DUE),
    }
    ready = standardized(every, ["INADIM"])
    refresh_all(every, RUN_AT, work_path(spark, "auditoria"), cluster_by={name: "dt_datavencimento" for name in ready})
    stored = tables.read_back(spark, "inadim").select(
        F.lit("inadim").alias("dataset"),
        "cdg_idlan", "cdg_idmov", "nm_recibo", "nm_descstatuslcto", "dt_datavencimento", "dt_databaixa",
        "vl_valororiginal", "vl_valorbaixado", "vl_txcartao", "vl_bruto", "cdg_codtmv", "nm_historico",
        F.lit(None).cast("bigint").alias("linhas"),
    )
    for name in ("fatofechamento", "plancc", "orcado"):
        count = tables.read_back(spark, name).agg(F.count(F.lit(1)).alias("linhas"))
        stored = stored.unionByName(count.withColumn("dataset", F.lit(name)), allowMissingColumns=True)
    return stored


@_query
def standardized_datasets(spark, sf):
    """Rows of two datasets extracted and standardised without a load; one is empty, one fails, one fails late."""
    every = {
        "titulos": lambda: view(spark, sf, "fx_text_amount"),
        "periodos": lambda: view(spark, sf, "fx_period"),
        "vazio": lambda: view(spark, sf, "fx_period").filter("id < 0"),
        "quebrado": lambda: view(spark, sf, "fx_period").select("inexistente"),
        "tarde": lambda: view(spark, sf, "fx_period").withColumn("x", F.raise_error(F.lit("linha"))),
        "fora": lambda: view(spark, sf, "fx_plan"),
    }
    ready = checked(every, ["Titulos", "PERIODOS", "vazio", "quebrado", "tarde"])
    found = None
    for name, (table, metrics) in ready.items():
        shown = table.select(
            F.lit(name).alias("dataset"), F.col(table.columns[0]).cast("bigint").alias("id"),
            *[F.col(c) if c in table.columns else F.lit(None).cast(t).alias(c) for c, t in (("vl_valor", "decimal(38,8)"), ("vl_ano", "int"))],
            F.lit(metrics["total_linhas"]).cast("bigint").alias("linhas"), F.lit(metrics["total_nulos"]).cast("bigint").alias("nulos"),
        )
        found = shown if found is None else found.unionByName(shown)
    return found


# --- plan against actual -----------------------------------------------------


def _labels(spark):
    rows = [(c, f"n4 {c}", label) for (c, _), label in mappings.NATURE_LABELS.items()]
    return mappings.fixed_table(spark, rows, ["prefixo", "descricao", "rotulo"])


def _executed(spark, sf):
    return planactual.executed_fact(
        view(spark, sf, "fx_fact"), mappings.recode_table(spark), _labels(spark), PLANS, LAST_MONTH
    )


def _planned(spark, sf):
    return budget.plan_filter(view(spark, sf, "fx_plan"), list(PLANS.values()), LAST_MONTH)


def _totals(spark, sf, by):
    return planactual.totals(planactual.plan_actual_lines(_planned(spark, sf), _executed(spark, sf)), by)


@_query
def recode_account(spark, sf):
    return planactual.recode_account(
        view(spark, sf, "fx_fact"), mappings.recode_table(spark), _labels(spark)
    ).select("nm_conta", "cdg_natorcamentonvl4", "nm_descnvl4", "vl_valor")


@_query
def executed_fact(spark, sf):
    return _executed(spark, sf)


@_query
def recode_account_sql(spark, sf):
    return sqlrules.recode_account(view(spark, sf, "fx_fact"), mappings.recode_table(spark), _labels(spark))


@_query
def executed_in_wanted_years(spark, sf):
    """The executed fact over a ledger stored by year; the budget's plans say which years are read."""
    fact = view(spark, sf, "fx_fact").withColumn("ano", F.year("nm_data"))
    tables.partitioned(fact, "fatos por ano", "ano")
    wanted = planactual.wanted_years(view(spark, sf, "fx_plan"), list(PLANS.values()))
    return planactual.executed_in(
        tables.read_back(spark, "fatos por ano"), wanted, mappings.recode_table(spark), _labels(spark), LAST_MONTH
    )


@_query
def plan_actual_keys(spark, sf):
    return planactual.plan_actual_keys(_planned(spark, sf), _executed(spark, sf))


@_query
def plan_actual(spark, sf):
    return planactual.plan_actual(_planned(spark, sf), _executed(spark, sf))


@_query
def plan_actual_month(spark, sf):
    return _totals(spark, sf, planactual.BY_MONTH)


@_query
def plan_actual_nature(spark, sf):
    return _totals(spark, sf, planactual.BY_NATURE)


@_query
def plan_actual_project(spark, sf):
    return _totals(spark, sf, planactual.BY_PROJECT)


@_query
def plan_actual_nested(spark, sf):
    payload = reports.plan_payload(_planned(spark, sf), _executed(spark, sf))
    return planactual.plan_actual_nested(payload["projeto"])


@_query
def json_payload(spark, sf):
    return tables.json_records(**reports.plan_payload(_planned(spark, sf), _executed(spark, sf)))


# --- coverage and dashboard --------------------------------------------------


def _coverage(spark, sf):
    fact = view(spark, sf, "fx_fact")
    return coverage.coverage(fact, [OLD, NEW], LAST_MONTH, revenue_groups=REVENUES)


_registered["coverage"] = _coverage


@_query
def telemetry(spark, sf):
    return coverage.telemetry(view(spark, sf, "fx_audit"))


@_query
def telemetry_metrics(spark, sf):
    return coverage.telemetry_metrics(view(spark, sf, "fx_audit_full"))


@_query
def telemetry_statistics(spark, sf):
    return coverage.telemetry_statistics(view(spark, sf, "fx_audit_full"))


@_query
def telemetry_schema(spark, sf):
    return coverage.telemetry_schema(view(spark, sf, "fx_audit"))


@_query
def units(spark, sf):
    return dashboard.units(_totals(spark, sf, planactual.BY_MONTH))


@_query
def unit_month_series(spark, sf):
    return dashboard.unit_month_series(_totals(spark, sf, planactual.BY_MONTH), [OLD, NEW])


@_query
def project_yoy(spark, sf):
    return dashboard.project_yoy(_totals(spark, sf, planactual.BY_PROJECT), OLD, NEW)


@_query
def nature_yoy(spark, sf):
    return dashboard.nature_yoy(_totals(spark, sf, planactual.BY_NATURE), OLD, NEW)


@_query
def nature_scaled(spark, sf):
    natures = dashboard.nature_yoy(_totals(spark, sf, planactual.BY_NATURE), OLD, NEW)
    return dashboard.nature_scaled(natures, OLD, NEW)


@_query
def coverage_unit(spark, sf):
    return dashboard.coverage_unit(_coverage(spark, sf), OLD, NEW)


@_query
def coverage_ranking(spark, sf):
    return dashboard.coverage_ranking(_coverage(spark, sf), OLD, NEW)


# --- delinquency -------------------------------------------------------------


def _base(spark, sf):
    joined = receivables.with_movement(
        view(spark, sf, "fx_instalment"), view(spark, sf, "fx_movement")
    )
    return delinquency.delinq_base(standardize.standardize(joined), [OLD, NEW])


def _flags(spark, sf):
    return delinquency.delinq_flags(_base(spark, sf), AS_OF, OLD)


def _flags_now(spark, sf):
    return delinquency.delinq_flags_now(_base(spark, sf), AS_OF)


_SHOWN = ["cdg_idlan", "cdg_idmov", "ano_venc", "mes_venc"]


@_query
def delinq_base(spark, sf):
    return _base(spark, sf).select(*_SHOWN, "vl_bruto", "vl_valororiginal", "vl_valorbaixado", "cdg_codtmv")


@_query
def delinq_flags(spark, sf):
    return _flags(spark, sf).select(*_SHOWN, "is_inadimplente", "status_simplificado")


@_query
def delinq_flags_sql(spark, sf):
    return sqlrules.delinq_flags(_base(spark, sf), AS_OF, OLD).select(*_SHOWN, "is_inadimplente", "status_simplificado")


@_query
def cash_timeline_sql(spark, sf):
    return sqlrules.cash_timeline(_base(spark, sf))


@_query
def delinq_flags_now(spark, sf):
    return _flags_now(spark, sf).select(*_SHOWN, "is_inadimplente", "status_simplificado")


@_query
def invoices_by_channel(spark, sf):
    return delinquency.invoices_by_channel(_flags(spark, sf), OLD, NEW)


def _bitmaps(spark, sf):
    flags = _flags(spark, sf)
    return delinquency.invoice_bitmaps(flags, delinquency.invoice_numbers(delinquency.created_in_time(flags)))


@_query
def invoices_by_channel_bitmap(spark, sf):
    return delinquency.invoices_from_bitmaps(_bitmaps(spark, sf), OLD, NEW)


@_query
def invoices_by_year_bitmap(spark, sf):
    """Distinct invoices of each year over all months and channels, and by channel over all months."""
    bitmaps = _bitmaps(spark, sf).checkpoint()
    whole = delinquency.count_bitmaps(bitmaps, ["ano_venc"]).withColumn("tipo_mov", F.lit(None).cast("string"))
    return whole.unionByName(delinquency.count_bitmaps(bitmaps, ["ano_venc", "tipo_mov"]))


@_query
def delinq_daily(spark, sf):
    return delinquency.delinq_daily(_base(spark, sf), AS_OF.replace(str(NEW), str(OLD)), AS_OF)


@_query
def invoices_no_outlier(spark, sf):
    counts = delinquency.invoices_by_channel(_flags(spark, sf), OLD, NEW)
    return delinquency.invoices_no_outlier(counts, ["2.1.1", "2.1.13"])


@_query
def channel_matrix(spark, sf):
    counts = delinquency.invoices_by_channel(_flags(spark, sf), OLD, NEW)
    return delinquency.channel_matrix(counts, OLD, NEW, CHANNELS)


@_query
def open_by_channel(spark, sf):
    return delinquency.open_by_channel(_flags(spark, sf), OLD, NEW)


@_query
def channel_impact(spark, sf):
    return delinquency.channel_impact(_flags(spark, sf))


@_query
def top_open(spark, sf):
    return delinquency.top_open(_flags(spark, sf))


@_query
def cash_timeline(spark, sf):
    return delinquency.cash_timeline(_base(spark, sf))


@_query
def count_timeline(spark, sf):
    return delinquency.count_timeline(_base(spark, sf))


@_query
def share_by_count(spark, sf):
    return delinquency.share_by_count(_flags_now(spark, sf))


@_query
def gross_dedup(spark, sf):
    return delinquency.gross_dedup(_flags_now(spark, sf))


@_query
def share_by_value(spark, sf):
    return delinquency.share_by_value(_flags_now(spark, sf))


@_query
def delinq_share_count(spark, sf):
    return delinquency.delinq_share_count(_flags_now(spark, sf))


@_query
def delinq_share_value(spark, sf):
    return delinquency.delinq_share_value(_flags_now(spark, sf))


@_query
def delinq_audit(spark, sf):
    return delinquency.delinq_audit(_flags_now(spark, sf), OLD, NEW)


# --- budget and ledger -------------------------------------------------------


@_query
def top_cost_centers(spark, sf):
    return study.top_cost_centers(view(spark, sf, "fx_fact"))


@_query
def budget_ledger_join(spark, sf):
    return study.budget_ledger_join(view(spark, sf, "fx_plan"), view(spark, sf, "fx_fact"), [OLD, NEW])


@_query
def budget_ledger_nature(spark, sf):
    return study.budget_ledger_nature(view(spark, sf, "fx_plan"), view(spark, sf, "fx_fact"), [OLD, NEW])
