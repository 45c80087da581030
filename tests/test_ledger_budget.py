import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.fixtures import OLD, view
from saldo.functions import joins
from saldo.operators import budget, hierarchy, ledger, mappings
from saldo.plans import datasets


def test_fixed_values_are_complete():
    assert len(mappings.CATEGORIES) == 33
    assert len(mappings.COLUMN_NAMES) == 116
    assert len(mappings.NATIONAL_CODES) == 10
    assert len(mappings.ACCOUNT_RECODES) == 8 and len(mappings.NATURE_LABELS) == 13
    accounts = [a for codes in mappings.NATIONAL_CODES.values() for a in codes]
    assert len(accounts) == len(set(accounts))


def test_fixed_table_keeps_rows_and_order(spark):
    rows = [("a", 1), ("b", 2), ("c", 3)]
    assert [tuple(r) for r in mappings.fixed_table(spark, rows, ["x", "y"]).collect()] == rows


@pytest.mark.parametrize(
    "debit, credit, expected", [(5, 3, None), (5, 0, 5), (0, 3, 3), (0, 0, 0), (None, 3, 3)]
)
def test_allocated_value(spark, debit, credit, expected):
    df = spark.createDataFrame([(debit, credit)], "d int, c int")
    assert df.select(ledger.allocated_value(F.col("d"), F.col("c"))).first()[0] == expected


@pytest.mark.parametrize(
    "leg, nature, sign", [("D", 1, 1), ("D", 0, -1), ("D", None, -1), ("C", 0, 1), ("C", 1, -1), ("C", None, -1)]
)
def test_signed_value(spark, leg, nature, sign):
    df = spark.createDataFrame([(leg, nature)], "l string, n int")
    assert df.select(ledger.signed_value(F.lit(7), F.col("l"), F.col("n"))).first()[0] == 7 * sign


def test_history_codes_compare_as_numbers(spark):
    rows = [("094",), ("820",), ("8",), (None,), ("texto",), ("98",)]
    df = spark.createDataFrame(rows, "codhistp string").withColumn("data", F.lit(dt.date(2024, 1, 1)))
    kept = [r.codhistp for r in ledger.ledger_filters(df).collect()]
    assert kept == ["8", None, "texto"]
    old = df.withColumn("data", F.lit(dt.date(2021, 12, 31)))
    assert ledger.ledger_filters(old).isEmpty()


def _ledger(spark):
    day = dt.date(2024, 5, 1)
    journal = spark.createDataFrame(
        [
            (1, 1, "3.1.1.1.01.001", "6.1.1.1.01.001", Decimal(10), day, None, "77", "x"),
            (2, 1, "3.1.1.1.01.001", "9.9.9.9.01.001", Decimal(20), day, "1", None, "y"),
        ],
        "lctref long, idpartida long, debito string, credito string, valor decimal(18,2), data date, "
        "codhistp string, integrachave string, complemento string",
    )
    allocations = spark.createDataFrame(
        [
            (100, 1, 1, "3.1.1.1.01.001", "G.00001.000001.001", Decimal(4), Decimal(0)),
            (101, 1, 1, "3.1.1.1.01.001", "G.00001.000001.002", Decimal(0), Decimal(6)),
        ],
        "idrateio long, lctref long, idpartida long, codconta string, codgerencial string, "
        "vlrdebito decimal(18,2), vlrcredito decimal(18,2)",
    )
    movements = spark.createDataFrame(
        [(77, "2.1.1", "C", 5, "u", day, Decimal(1))],
        "idmov long, codtmv string, campolivre1 string, codcfo long, codusuario string, "
        "dataemissao date, valorbrutoorig decimal(18,2)",
    )
    parties = spark.createDataFrame([(5, "Fornecedor")], "codcfo long, nome string")
    accounts = spark.createDataFrame(
        [
            ("3.1.1.1.01.001", "001", "Salários", 1, 1),
            ("6.1.1.1.01.001", "001", "Receita", 1, 0),
            ("3.1.1.1", "", "Pessoal nível 4", 0, 1),
            ("3", "", "Despesas", 0, 1),
        ],
        "codconta string, reduzido string, descricao string, analitica int, natureza int",
    )
    return journal, allocations, movements, parties, accounts


def test_ledger_legs_allocate_and_keep_unknown_movements(spark):
    legs = ledger.ledger_legs(*_ledger(spark)).select("lctref", "tipolancamento", "cc", "valor", "fornecedor")
    got = sorted(map(tuple, legs.collect()), key=repr)
    assert got == sorted(
        [
            (1, "D", "00001.000001.001", Decimal("4.00"), "Fornecedor"),
            (1, "D", "00001.000001.002", Decimal("6.00"), "Fornecedor"),
            (1, "C", None, Decimal("10.00"), "Fornecedor"),
            (2, "D", None, Decimal("20.00"), None),
        ],
        key=repr,
    )


def test_large_ledgers_move_once_for_allocations_and_once_for_movements(spark, monkeypatch):
    from saldo.functions import joins

    _, allocations, movements, parties, _ = _ledger(spark)
    legs = spark.range(50).select(
        F.col("id").alias("lctref"), F.lit(1).cast("bigint").alias("idpartida"),
        F.lit("3.1.1.1.01.001").alias("conta"), F.lit("D").alias("tipolancamento"),
        F.when(F.col("id") < 5, F.lit("77")).alias("integrachave"),
    )
    unknown = movements.union(movements.selectExpr("78", "codtmv", "campolivre1", "null", "codusuario", "dataemissao", "valorbrutoorig"))
    near = ledger.attach_movements(ledger.attach_allocations(legs, allocations), unknown, parties)
    expected = sorted(map(repr, near.collect()))
    monkeypatch.setattr(joins, "_surely_small", lambda df, size: False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        far = ledger.attach_movements(ledger.attach_allocations(legs, allocations), unknown, parties)
        plan = far._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(repr, far.collect())) == expected and far.columns == near.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The legs for each of two joins, allocations, movements by counterparty and by id, counterparties.
    assert plan.count("Exchange hashpartitioning") == 6
    assert sum(r.fornecedor == "Fornecedor" for r in far.collect()) == 6


def test_ledger_fact_has_the_published_columns(spark):
    journal, allocations, movements, parties, accounts = _ledger(spark)
    allow = spark.createDataFrame([("3.1.1.1.01.001",)], "conta string")
    legs = ledger.ledger_legs(journal, allocations, movements, parties, accounts, allow)
    centers = spark.createDataFrame(
        [("00001.000001.001", "Unidade"), ("00001", "Projeto"), ("00001.000001", "Ação")],
        "codccusto string, campolivre string",
    )
    levels = hierarchy.account_hierarchy(accounts, mappings.category_table(spark, "X"))
    fact = ledger.ledger_fact(
        legs, hierarchy.cost_center_hierarchy(centers), levels, mappings.national_table(spark)
    )
    assert len(fact.columns) == 27
    row = fact.filter("idrateio = 100").first()
    assert (row.acao, row.projeto, row.unidade) == ("Ação", "Projeto", "Unidade")
    assert (row.descnvl6, row.descnvl5, row.descnvl4, row.descnvl1) == (
        "Salários", None, "Pessoal nível 4", "Despesas",
    )
    assert row.categoria == "Pessoal" and row.nacional is None
    assert fact.count() == 3


def test_account_category_names_the_entity(spark):
    accounts = spark.createDataFrame(
        [("6.1.1.1.01.001",), ("5.1.2.2.01.001",), ("4.1.1.1.01.001",)], "codconta string"
    )
    got = {
        r.codconta[0]: (r.categoria, r.receita_despesa)
        for r in hierarchy.account_category(accounts, mappings.category_table(spark, "Casa")).collect()
    }
    assert got == {"6": ("Contribuição para o Casa (CSO)", 1), "5": ("Bens Móveis", 2), "4": (None, None)}


def test_national_code(spark):
    fact = spark.createDataFrame([("4.1.2.1.01.998",), ("6.1.1.1.01.001",), ("3.1.1.1.01.001",)], "conta string")
    got = {r.conta: r.nacional for r in ledger.national_code(fact, mappings.national_table(spark)).collect()}
    assert got == {"4.1.2.1.01.998": "6.2.1.2", "6.1.1.1.01.001": "6.2.1.1", "3.1.1.1.01.001": None}


def _centers(spark):
    rows = [
        ("00001.000001.001 ", "Unidade A"), ("00001.000001.002", "UNIDADE A"), ("00001.000001", "Ação"),
        ("00001", "Casa Aqui - Inaugurações e Revitalizações"), ("00002.000001.001", None),
    ]
    return spark.createDataFrame(rows, "codccusto string, campolivre string")


def test_cost_centers_correct_project_names(spark):
    fixes = mappings.project_corrections("Casa")
    got = {r.cc.strip(): r.projeto for r in hierarchy.cost_center_hierarchy(_centers(spark), fixes).collect()}
    assert got["00001.000001.002"] == "Casa Aqui - Inauguração e Revitalização"
    assert got["00002.000001.001"] is None and len(got) == 3


def test_concat_key_takes_missing_names_as_empty(spark):
    centers = spark.createDataFrame([("c", None, "Projeto", "Ação")], "cc string, acao string, projeto string, unidade string")
    assert hierarchy.concat_key(centers).first().chave_concat == "PROJETOAÇÃO"


def test_budget_matches_without_case_accents_and_blanks(spark):
    years = spark.createDataFrame(
        [("00001.000001.002", "2025"), ("00002.000001.001", "2025"), ("00001.000001.002", "2025")],
        "cc string, ano string",
    )
    centers = hierarchy.cost_center_hierarchy(_centers(spark), mappings.project_corrections("Casa"))
    cc_map = budget.budget_cc_map([years, years.filter("false")], centers)
    assert cc_map.count() == 2
    lines = spark.createDataFrame(
        [
            ("casa aqui - INAUGURACAO e revitalizacao", "acao", "Unidade A  ", 2025, 1),
            ("Outra", "acao", "Unidade A", 2025, 2),
            ("CANCELADO Outra", "acao", "Unidade A", 2025, 3),
            ("cancelado", "acao", "Unidade A", 2025, 4),
            (None, None, None, 2025, 5),
        ],
        "nm_iniciativa string, nm_acao string, nm_unidade string, vl_ano int, id int",
    )
    got = {r.id: r.nm_cc for r in budget.budget_with_cc(lines, cc_map).collect()}
    assert got == {1: "00001.000001.002", 2: None}


def test_budget_keeps_every_matching_cost_center(spark):
    cc_map = spark.createDataFrame(
        [("c1", 2025, "P", "A", "U"), ("c2", 2025, "p", "á", "u ")],
        "cc string, ano int, projeto string, acao string, unidade string",
    )
    line = spark.createDataFrame([("P", "A", "U", 2025)], "nm_iniciativa string, nm_acao string, nm_unidade string, vl_ano int")
    assert sorted(r.nm_cc for r in budget.budget_with_cc(line, cc_map).collect()) == ["c1", "c2"]


@pytest.mark.parametrize("most", [None, 0])
def test_budget_names_get_their_sort_key_once_a_spelling(spark, monkeypatch, most):
    if most is not None:  # no table is small enough to ship
        monkeypatch.setattr(joins.small_copy, "__defaults__", (most, most))
    cc_map = spark.createDataFrame(
        [("c1", 2025, "P", "A", "U"), ("c2", 2025, "p", "á", "u "), ("c2", 2025, "P ", "A", "U"), ("c3", 2025, "P", None, "V"),
         (None, 2025, "Q", "A", "U")],
        "cc string, ano int, projeto string, acao string, unidade string",
    )
    names = [
        ("P", "A", "U", 2025), ("p", "Á", "U  ", 2025), ("P", "A", "V", 2025), ("P", None, "v", 2025), ("Q", "A", "U", 2025),
        ("P", "A", "U", 2024), ("P", "A", "U", None), (None, "A", "U", 2025), ("Cancelado P", "A", "U", 2025),
    ]
    lines = spark.createDataFrame(
        [(*row, n) for n in range(20) for row in names],
        "nm_iniciativa string, nm_acao string, nm_unidade string, vl_ano int, n int",
    )
    joined = budget.budget_with_cc(lines, cc_map)
    assert joined.columns == [*lines.columns, "nm_cc"]
    both = ["c1", "c2"]  # "P " has its blank inside the key, so it is another name
    expected = [
        (*row, n, cc)
        for n in range(20)
        for row, centers in zip(names, (both, both, [None], ["c3"], [None], [None], [None]))
        for cc in centers
    ]
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(expected, key=repr)
    plan = joined._jdf.queryExecution().executedPlan().toString().split("\n")
    top = next(line for line in plan if "Join" in line)
    assert "_grafia" in top and "collationkey" not in top.lower()


@pytest.mark.parametrize("expansion", [joins.EXPANSION, 10**9])  # with the second, no table is small by its estimate
def test_reference_tables_of_the_ledger_are_computed_once(spark, small, monkeypatch, expansion):
    monkeypatch.setattr(joins, "EXPANSION", expansion)
    seen = {name: spark.sparkContext.accumulator(0) for name in ("CCONTA", "GCCUSTO")}
    tables = {name: view(spark, small, registry.SOURCES[name]) for name in registry.SOURCES}

    def source(name):
        if name not in seen:
            return tables[name]
        count, code = seen[name], tables[name].columns[0]

        def marked(value):
            count.add(1)
            return value

        return tables[name].withColumn(code, F.udf(marked, "string").asNondeterministic()(code))

    found = datasets.fatofechamento(spark, source, registry.ENTITY, first_year=OLD)
    assert found.count() > 0
    assert {name: n.value for name, n in seen.items()} == {name: tables[name].count() for name in seen}
