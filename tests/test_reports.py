import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saldo.operators import coverage, dashboard, mappings, planactual

KEYS = "vl_ano int, vl_mes int, nm_iniciativa string, nm_acao string, nm_unidade string, nm_cc string, cdg_natorcamentonvl4 string"


def _planned(spark, rows):
    return spark.createDataFrame(rows, KEYS + ", nm_natorcamentonvl4 string, vl_ajustado decimal(18,2)")


def _executed(spark, rows):
    return spark.createDataFrame(rows, KEYS + ", nm_descnvl4 string, vl_valor decimal(28,2)")


@pytest.fixture(scope="module")
def sides(spark):
    planned = _planned(
        spark,
        [
            (2025, 1, "I", "A1", "U1", "c", "3.1", "nat x", Decimal(10)),
            (2025, 1, "I", "A1", "U1", "c", "3.1", "nat x", Decimal(5)),
            (2025, 1, "I", "A1", "U1", "c", "3.1", None, None),
            (2025, 1, "I", "A1", None, None, "3.1", "nat x", Decimal(7)),
        ],
    )
    executed = _executed(
        spark,
        [
            (2025, 1, "I", "A2", "U2", "c", "3.1", "real", Decimal(3)),
            (2025, 1, "I", "A3", "U2", "c", "3.1", "outro", Decimal(4)),
            (2025, 2, "I", "A2", "U2", "c", "3.1", "real", Decimal(9)),
        ],
    )
    return planned, executed


def test_keys_that_differ_in_action_share_amounts(spark, sides):
    rows = planactual.plan_actual(*sides).collect()
    shared = [r for r in rows if r.vl_mes == 1 and r.nm_cc == "c"]
    assert len(shared) == 3 * 3 * 2
    alone = [r for r in rows if r.nm_cc is None]
    assert [(r.vl_ajustado, r.vl_valor) for r in alone] == [(0, 0)]


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("by", [planactual.BY_MONTH, planactual.BY_NATURE, planactual.BY_PROJECT])
def test_totals_equal_the_sum_of_the_rows(spark, sides, by, strict):
    rows = planactual.plan_actual(*sides, strict=strict)
    direct = (
        rows.dropna(subset=by).groupBy(*by)
        .agg(F.sum("vl_ajustado").alias("planejado"), F.sum("vl_valor").alias("executado"))
    )
    quick = planactual.totals(planactual.plan_actual_lines(*sides, strict=strict), by)
    assert sorted(map(tuple, quick.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)
    assert not quick.filter("nm_unidade is null").count()


def test_strict_totals_equal_the_inputs(spark, sides):
    planned, executed = sides
    kept = planned.dropna(subset=planactual.KEYS)
    lines = planactual.plan_actual_lines(kept, executed, strict=True)
    got = lines.agg(F.sum("planejado"), F.sum("executado")).first()
    assert tuple(got) == (Decimal(15), Decimal(16))


def test_wide_money_keeps_eight_places(spark):
    planned = _planned(spark, [(2025, 1, "I", "A", "U", "c", "3", "n", Decimal(1))]).withColumn(
        "vl_ajustado", F.lit("0.00000003").cast("decimal(38,8)")
    )
    executed = _executed(spark, [(2025, 1, "I", "A", "U", "c", "3", "n", Decimal(1))]).withColumn(
        "vl_valor", F.lit("0.00000005").cast("decimal(38,8)")
    )
    row = planactual.totals(planactual.plan_actual_lines(planned, executed), planactual.BY_MONTH).first()
    assert (row.planejado, row.executado) == (Decimal("3E-8"), Decimal("5E-8"))


def _fact(spark, rows):
    return spark.createDataFrame(
        rows,
        "nm_unidade string, nm_data date, vl_valor string, nm_descnvl1 string, nm_descnvl3 string, "
        "nm_conta string, nm_descnvl4 string, nm_projeto string, nm_acao string, nm_cc string",
    )


def _row(unit, day, value, level1="DESPESAS", level3="x", account="3.1.1.1.01.001", level4="d"):
    return (unit, dt.date.fromisoformat(day), value, level1, level3, account, level4, "P", "A", "c")


def test_recode_and_executed(spark):
    fact = _fact(
        spark,
        [
            _row("U", "2025-01-05", "1", "despesas ", account="5.2.2.1.01.001", level4="Bens Imóveis"),
            _row("U", "2025-01-09", "2", account="5.2.2.1.01.003", level4="BENS IMÓVEIS"),
            _row("U", "2025-02-01", "4", account="3.1.2.1.01.001", level4="outra"),
            _row("U", "2025-04-01", "8"),
            _row("U", "2024-01-01", "16"),
            _row("U", "2025-01-01", "32", "RECEITAS"),
        ],
    ).withColumn("vl_valor", F.col("vl_valor").cast("decimal(18,2)"))
    got = planactual.executed_fact(
        fact, mappings.recode_table(spark), mappings.label_table(spark), mappings.PLAN_LABELS
    )
    rows = sorted((r.nm_ppa, r.cdg_natorcamentonvl4, r.nm_descnvl4, r.vl_mes, int(r.vl_valor)) for r in got.collect())
    assert rows == [
        ("PPA 2025 - 2025/Mar", "3.1.2.1", "outra", 2, 4),
        ("PPA 2025 - 2025/Mar", "5.1.2.1", "BENS IMÓVEIS", 1, 3),
    ]


def test_coverage_rules(spark):
    revenue = mappings.REVENUE_GROUPS[0]
    fact = _fact(
        spark,
        [
            _row(" U1 ", "2025-01-01", "200", "Despesas gerais"),
            _row(" U1 ", "2025-02-01", "50", "RECEITAS", revenue.lower()),
            _row(" U1 ", "2025-02-01", "ilegível", "DESPESAS"),
            _row("U2", "2025-03-31", "30", "RECEITAS", revenue),
            _row(None, "2025-01-01", "5", "DESPESAS"),
            _row(None, "2025-01-01", "6", "RECEITAS", revenue),
            _row("U3", "2025-04-01", "1", "DESPESAS"),
        ],
    )
    got = sorted(map(tuple, coverage.coverage(fact, [2025, 2026]).collect()), key=repr)
    assert got == sorted(
        [
            ("U1", 2025, 200.0, 50.0, -150.0, 25.0),
            ("U2", 2025, 0.0, 30.0, 30.0, 0.0),
            (None, 2025, 5.0, 0.0, -5.0, 0.0),
            (None, 2025, 0.0, 6.0, 6.0, 0.0),
        ],
        key=repr,
    )


def test_telemetry_orders_and_replaces_bad_json(spark):
    audit = spark.createDataFrame(
        [("a", "2026-01-01 00:00:00", 1, 2, 3, "{quebrado"), ("b", "2026-02-01 00:00:00", 1, 2, 3, '{"x":1}'),
         ("c", "2025-02-01 00:00:00", 1, 2, 3, None)],
        "nome_processo string, data_execucao string, total_linhas long, total_colunas int, total_nulos long, detalhes_json string",
    ).withColumn("data_execucao", F.col("data_execucao").cast("timestamp"))
    got = [(r.nome_processo, r.detalhes) for r in coverage.telemetry(audit).collect()]
    assert got == [("b", '{"x":1}'), ("a", "{}"), ("c", "{}")]


def test_dashboard_tables(spark):
    months = spark.createDataFrame(
        [("U", 2025, 3, 10.5, -2.5), ("U", 2025, 13, 1.0, 1.0), ("V", 2026, 1, 0.4, 0.6)],
        "nm_unidade string, vl_ano int, vl_mes int, planejado double, executado double",
    )
    series = dashboard.unit_month_series(months, [2025, 2026], "U").collect()
    assert [(r.nome, r.planejado, r.executado) for r in series] == [("Março", 11, -2), ("Mês 13", 1, 1)]
    assert [r.nm_unidade for r in dashboard.units(months).collect()] == ["U", "V"]

    projects = spark.createDataFrame(
        [("U", "p", 2025, 10.0, 0.0), ("U", "p", 2026, 5.0, 5.0), ("U", "q", 2026, 1.0, 0.0)],
        "nm_unidade string, nm_iniciativa string, vl_ano int, planejado double, executado double",
    )
    yoy = {r.nm_iniciativa: (r.var_planejado, r.var_executado) for r in dashboard.project_yoy(projects, 2025, 2026).collect()}
    assert yoy == {"p": (-50.0, 100.0), "q": (100.0, 0.0)}

    natures = spark.createDataFrame(
        [("U", "NATUREZA COM NOME LONGO", 2025, 100.4), ("U", "NATUREZA COM NOME LONGO", 2026, 50.0), ("U", "B", 2026, 200.0)],
        f"nm_unidade string, {planactual.NATURE} string, vl_ano int, executado double",
    )
    table = dashboard.nature_yoy(natures, 2025, 2026)
    rows = [(r.nome, r.executado_2025, r.delta) for r in table.collect()]
    assert rows == [("NATUREZA COM NOME LO...", 100, -50.0), ("B", 0, 100.0)]
    scaled = {r.nome_completo: (r.posicao_2025, r.posicao_2026) for r in dashboard.nature_scaled(table, 2025, 2026).collect()}
    assert scaled == {"NATUREZA COM NOME LONGO": (50.0, 25.0), "B": (0.0, 100.0)}


def test_ranking_positions(spark):
    rows = spark.createDataFrame(
        [("B", 2025, 10.0), ("B", 2026, 30.0), ("A", 2026, 30.0), ("C", 2025, 99.0)],
        "unidade string, ano int, indice_cobertura double",
    )
    got = [tuple(r) for r in dashboard.coverage_ranking(rows, 2025, 2026).orderBy("posicao").select("unidade", "variacao", "posicao").collect()]
    assert got == [("A", 0.0, 1), ("B", 20.0, 2), ("C", -99.0, 3)]


def test_nested_document(spark):
    totals = spark.createDataFrame(
        [("U", "b", 2026, Decimal(1), Decimal(2)), ("U", "a", 2026, Decimal(3), Decimal(4)), ("U", "a", 2025, Decimal(5), Decimal(6))],
        "nm_unidade string, nm_iniciativa string, vl_ano int, planejado decimal(10,0), executado decimal(10,0)",
    )
    found = {r.nm_iniciativa: r.anos for r in planactual.plan_actual_nested(totals).collect()}
    assert found == {
        "a": '{"2025":{"planejado":5,"executado":6},"2026":{"planejado":3,"executado":4}}',
        "b": '{"2026":{"planejado":1,"executado":2}}',
    }


def test_names_that_differ_in_case_are_one_key(spark):
    planned = spark.createDataFrame(
        [(2026, 1, "Obra", "A", "Sul", "1", "31", "n", Decimal(5))],
        "vl_ano int, vl_mes int, nm_iniciativa string, nm_acao string, nm_unidade string, nm_cc string, "
        "cdg_natorcamentonvl4 string, nm_natorcamentonvl4 string, vl_ajustado decimal(18,2)",
    )
    executed = spark.createDataFrame(
        [(2026, 1, "OBRA ", "a", "SUL", "1", "31", "n", Decimal(7))],
        "vl_ano int, vl_mes int, nm_iniciativa string, nm_acao string, nm_unidade string, nm_cc string, "
        "cdg_natorcamentonvl4 string, nm_descnvl4 string, vl_valor decimal(18,2)",
    )
    rows = planactual.plan_actual(planned, executed).collect()
    assert [(r.nm_unidade, r.vl_ajustado, r.vl_valor) for r in rows] == [("SUL", Decimal(5), Decimal(7))]
    lines = planactual.plan_actual_lines(planned, executed)
    assert [(r.planejado, r.executado) for r in planactual.totals(lines, planactual.BY_MONTH).collect()] == [(5, 7)]
