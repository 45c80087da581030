"""Parsed audit details, stored layouts that spare work, balanced slices, rules as SQL functions."""

import datetime as dt
import json
import logging
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.fixtures import AS_OF, FIRST_DUE, LAST_MONTH, OLD, PLANS, view
from saldo.functions import joins
from saldo.operators import coverage, delinquency, ledger, mappings, planactual, receivables
from saldo.plans import sqlrules
from saldo.plans.refresh import checked, refresh_all
from saldo.sources import funds, relational, tables


def ordered(df):
    return sorted(map(tuple, df.collect()), key=repr)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan()


# --- audit details -----------------------------------------------------------


def test_stored_trail_has_parsed_details(spark, small, tmp_path):
    trail = str(tmp_path / "trilha")
    sources = {
        "orcado": lambda: view(spark, small, "fx_plan"), "titulos": lambda: view(spark, small, "fx_text_amount"),
        "contas": lambda: view(spark, small, "fx_account"), "quebrado": lambda: view(spark, small, "fx_plan").select("x"),
    }
    refresh_all(sources, "2026-07-01 06:00:00", trail)
    stored = tables.audit_trail(spark, trail)
    assert dict(stored.dtypes)["detalhes"] == "variant" and stored.filter("detalhes is null").count() == 0
    metrics = {r.nome_processo: r for r in coverage.telemetry_metrics(stored).collect()}
    for name in ("orcado", "titulos", "contas"):
        table = tables.read_back(spark, name)
        assert metrics[name].linhas == table.count() and metrics[name].colunas == len(table.columns)
    assert metrics["titulos"].soma_faixas is not None and metrics["orcado"].soma_faixas is None
    statistics = {(r.nome_processo, r.coluna): r for r in coverage.telemetry_statistics(stored).collect()}
    years = tables.read_back(spark, "orcado").agg(F.sum("vl_ano").cast("double"), F.max("vl_ano").cast("double")).first()
    assert tuple(years) == (statistics["orcado", "vl_ano"].soma_total, statistics["orcado", "vl_ano"].maximo)
    assert {c for n, c in statistics if n == "contas"} == {"analitica", "natureza"} or ("contas", "cdg_natureza") in statistics
    shapes = {r.nome_processo: r.esquema for r in coverage.telemetry_schema(stored).collect()}
    assert "vl_ano: OBJECT<" in shapes["orcado"] and shapes["orcado"].startswith("OBJECT<estatisticas_numericas: ")


def test_trails_of_text_are_parsed_when_read(spark, tmp_path):
    trail = str(tmp_path / "antiga")
    details = {"kpis_gerais": {"total_linhas": 5}, "estatisticas_numericas": {"a": {"media": "x", "maximo": 2}}}
    rows = [("a", dt.datetime(2026, 1, 1), 5, 1, 0, json.dumps(details)), ("b", dt.datetime(2026, 1, 1), 5, 1, 0, "{"), ("c", None, None, None, None, None)]
    spark.createDataFrame(rows, tables.AUDIT_SCHEMA).write.parquet(trail)
    stored = tables.audit_trail(spark, trail)
    assert {r.nome_processo: r.linhas for r in coverage.telemetry_metrics(stored).collect()} == {"a": 5, "b": None, "c": None}
    assert [(r.coluna, r.media, r.maximo) for r in coverage.telemetry_statistics(stored).collect()] == [("a", None, 2.0)]


# --- stored by year ----------------------------------------------------------


def test_only_the_wanted_years_are_opened(spark, small, tmp_path):
    """Eight of ten years hold files that cannot be read; the report of two years does not notice."""
    fact = view(spark, small, "fx_fact")
    shifted = [fact.withColumn("nm_data", F.add_months("nm_data", 12 * k)) for k in range(4)]
    years = shifted[0].unionByName(shifted[1]).unionByName(shifted[2]).unionByName(shifted[3])
    place = str(tmp_path / "fatos")
    years.withColumn("ano", F.year("nm_data")).write.partitionBy("ano").parquet(place)
    whole = spark.read.parquet(place)
    found = sorted(int(d.split("=")[1]) for d in os.listdir(place) if "=" in d)
    assert len(found) == 10
    wanted = [int(y) for y in PLANS]
    for year in found:
        if year not in wanted:
            with open(f"{place}/ano={year}/part-broken.parquet", "wb") as out:
                out.write(b"not parquet")
    stored = spark.read.schema(whole.schema).parquet(place)
    budget = view(spark, small, "fx_plan")
    pairs = planactual.wanted_years(budget, list(PLANS.values()))
    codes, labels = mappings.recode_table(spark), registry._labels(spark)
    got = planactual.executed_in(stored, pairs, codes, labels, LAST_MONTH)
    assert "dynamicpruning" in physical(got)
    plain = planactual.executed_fact(years, codes, labels, PLANS, LAST_MONTH)
    assert ordered(got.select(*plain.columns)) == ordered(plain) != []
    with pytest.raises(Exception, match="(?i)parquet"):
        stored.agg(F.sum("vl_valor")).collect()


def test_too_many_plan_years_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(planactual, "MOST_PLAN_YEARS", 2)
    budget = spark.createDataFrame([(y, "p") for y in range(3)], "vl_ano int, nm_ppa string")
    with pytest.raises(ValueError, match="3 pairs"):
        planactual.wanted_years(budget, ["p"])


def test_partitioned_tables_read_back_whole(spark):
    rows = [(k, 2000 + k % 3 if k % 7 else None) for k in range(50)]
    tables.partitioned(spark.createDataFrame(rows, "id int, ano int"), "por ano", "ano")
    assert ordered(tables.read_back(spark, "por ano")) == ordered(spark.createDataFrame(rows, "id int, ano int"))


# --- buckets -----------------------------------------------------------------


def exchanges(plan, table):
    """Exchanges between a join and the scan of ``table``."""
    lines = plan.split("\n")
    at = next(k for k, line in enumerate(lines) if "FileScan" in line and table in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    found, level = 0, depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            if "Join" in line:
                return found
            found += "Exchange" in line
    raise AssertionError("no join above the scan")


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    from saldo.functions import joins

    monkeypatch.setattr(joins.skewed_left_join, "__defaults__", (False, joins.ROWS_PER_TASK, 0, False))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_receivables_do_not_shuffle_bucketed_movements(spark, small, no_broadcast):
    movements = view(spark, small, "fx_movement")
    stored = tables.store_bucketed(movements, "movimentos teste", "idmov", 8)
    due = receivables.due_between(view(spark, small, "fx_instalment"), AS_OF, FIRST_DUE)
    joined = receivables.with_movement(due, stored)
    assert exchanges(physical(joined), "movimentos_teste") == 0
    plain = receivables.with_movement(due, movements)
    assert ordered(joined.withColumn("valorbrutoorig", F.col("valorbrutoorig").cast("decimal(18,2)"))) == ordered(plain)


def test_ledger_does_not_shuffle_bucketed_movements(spark, small, no_broadcast):
    keyed = ledger.with_movement_key(view(spark, small, "fx_movement"))
    stored = tables.store_bucketed(keyed, "movimentos chave teste", ledger.MOVEMENT_KEY, 8)
    legs = view(spark, small, "fx_journal").withColumn("tipolancamento", F.lit("D"))
    joined = ledger.attach_movements(legs, stored, view(spark, small, "fx_counterparty"))
    assert exchanges(physical(joined), "movimentos_chave_teste") == 0
    assert ordered(joined) == ordered(ledger.attach_movements(legs, view(spark, small, "fx_movement"), view(spark, small, "fx_counterparty")))


# --- balanced slices ---------------------------------------------------------


def skewed_keys(n=5000):
    draw = random.Random(11)
    return [int(draw.paretovariate(0.4)) % 10**9 for _ in range(n)]


@pytest.mark.parametrize("slices", [1, 2, 7, 64])
def test_slices_follow_the_keys(spark, slices):
    draw = random.Random(5)
    keys = sorted({int(draw.paretovariate(0.3)) % 10**12 for _ in range(20_000)})
    table = spark.createDataFrame([(k,) for k in keys] + [(None,)] * 20, "id bigint")
    parts = relational.balanced_predicates(table.sample(0.5, seed=1), "id", slices)
    sizes = [table.filter(p).count() for p in parts]
    assert len(parts) == slices and sum(sizes) == len(keys) + 20
    assert max(sizes) <= 2 * sum(sizes) / slices
    low, high = keys[0], keys[-1]
    width = (high - low) / slices
    equal = [sum(low + k * width <= x < low + (k + 1) * width for x in keys) for k in range(slices)]
    assert slices == 1 or max(equal) > max(sizes)


@pytest.mark.parametrize("rows, slices", [(1629, 64), (1595, 64), (99, 50), (10, 7)])
def test_no_slice_takes_what_the_others_miss(spark, rows, slices):
    table = spark.range(rows)
    sizes = [table.filter(p).count() for p in relational.balanced_predicates(table, "id", slices)]
    assert len(sizes) == slices and sum(sizes) == rows
    assert max(sizes) <= -(-rows // slices)


def test_repeated_keys_make_slices_of_their_own(spark):
    keys = skewed_keys()
    table = spark.createDataFrame([(k,) for k in keys], "id bigint")
    parts = relational.balanced_predicates(table, "id", 10)
    sizes = [table.filter(p).count() for p in parts]
    most = max(keys.count(k) for k in set(keys))
    assert sum(sizes) == len(keys) and max(sizes) <= max(most, 2 * len(keys) / 10)


@pytest.mark.parametrize(
    "kind, values",
    [
        ("string", ["a", "b'c", "d", "é", "z"]),
        ("date", [dt.date(2020, 1, k) for k in range(1, 6)]),
        ("timestamp", [dt.datetime(2020, 1, k, 12, 30, 5) for k in range(1, 6)]),
        ("decimal(10,2)", [Decimal(k) / 4 for k in range(5)]),
        ("double", [0.5, -1.5, 2.25, 1e10, -1e-3]),
    ],
)
def test_keys_of_other_types(spark, kind, values):
    table = spark.createDataFrame([(v,) for v in values * 20] + [(None,)], f"k {kind}")
    parts = relational.balanced_predicates(table, "k", 4)
    assert len(parts) == 4 and sum(table.filter(p).count() for p in parts) == 101


def test_nothing_to_divide(spark):
    empty = spark.createDataFrame([(None,)], "k int")
    assert relational.balanced_predicates(empty, "k", 5) == ["1 = 1"]
    with pytest.raises(ValueError):
        relational.balanced_predicates(empty, "k", 0)
    with pytest.raises(TypeError):
        relational.balanced_predicates(spark.createDataFrame([(True,), (False,)], "k boolean"), "k", 2)


def test_a_script_without_a_result_is_an_empty_table(spark, caplog):
    with caplog.at_level(logging.WARNING):
        got = relational.read_relational(spark, "jdbc:none", " ")
    assert got.columns == [] and got.count() == 0 and "no SELECT" in caplog.text


# --- extracted without a load, stored parameters, sizes ----------------------


def test_checked_datasets_were_computed_whole(spark):
    good = spark.createDataFrame([(1, "1.234,5"), (2, None)], "id int, vl_valor string")
    every = {
        "a": lambda: good, "empty": lambda: good.limit(0), "broken": lambda: good.select("x"),
        "late": lambda: good.withColumn("y", F.when(F.col("id") == 2, F.raise_error(F.lit("row"))).otherwise(F.lit("z"))),
    }
    ready = checked(every)
    assert list(ready) == ["a"]
    table, metrics = ready["a"]
    assert metrics["total_linhas"] == table.count() == 2 and sorted(float(r.vl_valor) for r in table.collect()) == [0.0, 1234.5]
    assert list(checked(every, ["A", "late"])) == ["a"] and checked({}) == {}


def test_fund_parameters_come_from_a_document(spark, tmp_path):
    one, many, bad = (str(tmp_path / n) for n in ("one.json", "many.json", "bad.json"))
    fund = {"cnpj_fundo": "001", "data_referencia": "09/2025"}
    for place, content in ((one, json.dumps(fund, indent=4)), (many, json.dumps([fund, fund, {**fund, "cnpj_fundo": "002"}])), (bad, "{")):
        with open(place, "w") as out:
            out.write(content)
    assert ordered(funds.read_wanted(spark, one)) == [("001", "09/2025")]
    assert ordered(funds.read_wanted(spark, many)) == [("001", "09/2025"), ("002", "09/2025")]
    documents = spark.createDataFrame(
        [(k, f, mappings.FUND_REPORT_TYPE, "09/2025", "") for k, f in enumerate(["001", "002", "003"])],
        "id int, fundo string, tipo_documento string, data_referencia string, content string",
    )
    assert [r.fundo for r in funds.select_fund_documents(documents, funds.read_wanted(spark, one)).collect()] == ["001"]
    with pytest.raises(Exception, match="(?i)malformed"):
        funds.read_wanted(spark, bad).collect()


def test_files_that_unpack_to_much_are_measured(spark, tmp_path):
    """A table whose files are within the limit, and whose rows are not, is not broadcast."""
    place = str(tmp_path / "t")
    spark.range(3000).select("id", F.repeat(F.lit("x"), 2000).alias("v")).coalesce(1).write.parquet(place)
    stored = spark.read.parquet(place)
    limit = 100_000
    assert sum(os.path.getsize(f"{place}/{f}") for f in os.listdir(place)) < limit
    assert joins.small_copy(stored, max_bytes=limit) is None


def test_only_one_process_gets_a_folder_of_its_own():
    from types import SimpleNamespace

    from saldo.session import is_local

    masters = {"local": True, "local[4]": True, "local[*]": True, "local-cluster[3,2,1024]": False, "yarn": False, "spark://h:7077": False}
    for master, own in masters.items():
        assert is_local(SimpleNamespace(sparkContext=SimpleNamespace(master=master))) == own


def test_of_refreshes_at_once_the_later_one_counts(spark):
    """Both ask for a version before either is published; names in any order."""
    import time

    first, second = sorted((tables.new_version(spark, "zugleich") for _ in range(2)), reverse=True)
    spark.range(1).write.parquet(first)
    spark.range(2).write.parquet(second)
    tables.publish(spark, "zugleich", first)
    assert tables.read_back(spark, "zugleich").count() == 1
    time.sleep(1.1)
    tables.publish(spark, "zugleich", second)
    assert tables.read_back(spark, "zugleich").count() == 2
    assert tables.retain(spark, "zugleich", keep=1) and tables.read_back(spark, "zugleich").count() == 2


# --- rules as SQL functions --------------------------------------------------


def test_sql_reports_are_planned_like_the_operators(spark, small):
    base = registry._base(spark, small)
    flags = sqlrules.delinq_flags(base, AS_OF, OLD)
    operators = delinquency.delinq_flags(base, AS_OF, OLD)
    assert flags.columns == operators.columns and optimised(flags).sameResult(optimised(operators))
    assert ordered(flags) == ordered(operators)
    cash, same = sqlrules.cash_timeline(base), delinquency.cash_timeline(base)
    assert cash.columns == same.columns and cash.collect() == same.collect()
    assert "saldo_" not in physical(cash)
    fact, codes, labels = view(spark, small, "fx_fact"), mappings.recode_table(spark), registry._labels(spark)
    coded = sqlrules.recode_account(fact, codes, labels)
    assert physical(coded).count("BroadcastHashJoin") >= 2 and "Exchange hashpartitioning" not in physical(coded)
    plain = planactual.recode_account(fact, codes, labels).select(*coded.columns)
    assert ordered(coded) == ordered(plain)


def test_rules_can_be_called_from_any_statement(spark):
    assert set(sqlrules.register(spark)) >= {"saldo_atrasado", "saldo_corte", "saldo_chave"}
    got = spark.sql(
        "SELECT saldo_atrasado(TIMESTAMP '2026-01-01', NULL, TIMESTAMP '2026-02-01') AS a, "
        "saldo_atrasado(NULL, NULL, TIMESTAMP '2026-02-01') AS b, saldo_chave('Ação  ') AS c, saldo_prefixo('1.2.3.4.5') AS d"
    ).first()
    assert tuple(got) == (True, False, "AÇÃO", "1.2.3.4")
