import json
import os
import subprocess
import sys
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saldo.operators import quality, standardize
from saldo.plans.refresh import refresh_all, standardized
from saldo.session import tables_dir, work_path
from saldo.sources import relational, tables

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize(
    "source, expected",
    [
        ("[Foto].[Foto].[Nome].[MEMBER_CAPTION]", "foto_nome"),
        ("[Key]", "key"),
        ("Valor (R$)", "valor_r"),
        ("  Situação do Título ", "situação_do_título"),
        ("x" * 130, "x" * 120),
        ("[a b].[a-b].[Caption]", "a_b"),
    ],
)
def test_fallback_name(source, expected):
    assert standardize.fallback_name(source) == expected


@given(st.text(max_size=200))
def test_fallback_name_is_short_and_clean(source):
    name = standardize.fallback_name(source)
    assert len(name) <= 120 and name == name.strip("_")


def test_rename_reports_and_refuses_duplicates():
    report = standardize.rename_report(["CC", " Valor ", "Novo"])
    assert report == {"total": 3, "renamed": 2, "unmapped": ["novo"]}
    with pytest.raises(ValueError, match="nm_acao"):
        standardize.standard_names(["acao", "[Ação].[Ação].[Ação].[MEMBER_CAPTION]"])


@pytest.mark.parametrize("rows, expected", [(["12.5", "1,5"], [125.0, 1.5]), (["12.5", "3", None], [12.5, 3.0, 0.0])])
def test_value_column_format_is_decided_once(spark, rows, expected):
    df = spark.createDataFrame([(v,) for v in rows], "vl_valor string")
    assert [r.vl_valor for r in standardize.parse_value_column(df).collect()] == expected


def test_missing_ledger_value_becomes_zero(spark):
    df = spark.createDataFrame([(Decimal("1.5"),), (None,)], "valor decimal(18,2)")
    got = standardize.standardize(df)
    assert [r.vl_valor for r in got.collect()] == [Decimal("1.50000000"), Decimal("0E-8")]
    assert got.dtypes == [("vl_valor", "decimal(38,8)")]


def test_money_and_year_columns_by_declared_type(spark):
    df = spark.createDataFrame(
        [("2025.7", 3, 1.5, 7, "a", Decimal("1.23"))],
        "vl_ano string, vl_mes int, vl_x double, vl_n bigint, nm_a string, taxa decimal(9,2)",
    )
    assert dict(standardize.standardize(df).dtypes) == {
        "vl_ano": "int", "vl_mes": "int", "vl_x": "decimal(38,8)", "vl_n": "bigint",
        "nm_a": "string", "taxa": "decimal(38,8)",
    }


def test_wide_decimals_are_rounded_or_dropped(spark):
    df = spark.sql("select cast(x as decimal(38,9)) as vl_a, cast(y as decimal(38,2)) as vl_b from values "
                   "('0.000000015', '1.25'), ('1', '123456789012345678901') as t(x, y)")
    rows = standardize.decimal_scale(df).collect()
    assert [tuple(r) for r in rows] == [(Decimal("2E-8"), Decimal("1.25")), (Decimal(1), None)]


def test_fund_path_parses_values(spark):
    df = spark.createDataFrame(
        [(" a.1) x", "1.000,50"), ("a.8) x", "5,00"), ("b.7) x", "2,00"), ("a.10) x", "9,00"), (" b.1)", "-")],
        "Descricao string, Valor_Str string",
    )
    ready = standardize.standardize(df)
    assert ready.columns == ["nm_descricao", "vl_valor"]
    row = quality.fund_kpis(ready).first()
    assert tuple(row) == (Decimal("1000.50"), Decimal("2.00"), Decimal("1002.50"))


def test_statistics_skip_money_unless_asked(spark):
    df = spark.createDataFrame([(Decimal(1), 2, 3.0), (Decimal(3), 4, None)], "d decimal(9,2), i int, f double")
    stats = {r.coluna: (r.soma_total, r.media, r.maximo, r.minimo) for r in quality.numeric_stats(df).collect()}
    assert stats == {"i": (6.0, 3.0, 4.0, 2.0), "f": (3.0, 3.0, 3.0, 3.0)}
    assert {r.coluna for r in quality.numeric_stats(df, True).collect()} == {"d", "i", "f"}
    assert quality.quality_metrics(df).first()["total_nulos"] == 1


def test_replace_twice_keeps_one_copy_and_failure_keeps_the_old(spark):
    tables.load_replace(spark.range(3), "Teste Troca")
    tables.load_replace(spark.range(5), "teste troca ")
    assert tables.read_back(spark, "TESTE TROCA").count() == 5
    broken = spark.range(2).select(F.raise_error(F.lit("parada")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="parada"):
        tables.load_replace(broken, "teste troca")
    assert tables.read_back(spark, "teste troca").count() == 5


def test_clustered_files_cover_short_ranges_even_with_a_hot_value(spark):
    days = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 50).alias("dia")
    rows = spark.range(0, 30_000, 1, 4).select("id", days)
    spread = tables.clustered(rows, "dia").groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("n"), F.min("dia").alias("lo"), F.max("dia").alias("hi")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = spread.orderBy("p").collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(p.n for p in parts) == 30_000 and len(parts) > 1
    assert all(a.hi <= b.lo for a, b in zip(parts, parts[1:]))
    assert max(p.n for p in parts) < 15_000


def test_clustered_refresh_counts_once(spark):
    trail = work_path(spark, "auditoria")
    rows = spark.range(500).select(F.col("id").alias("IDLAN"), (F.col("id") % 9).cast("int").alias("vl_mes"))
    refresh_all({"ordenada": lambda: rows}, "2026-01-02 03:04:05", trail, cluster_by={"ordenada": "vl_mes"})
    assert spark.read.parquet(trail).first().total_linhas == 500
    assert tables.read_back(spark, "ordenada").count() == 500


def test_typed_columns_of_a_stored_table(spark):
    df = spark.createDataFrame([("2025", 1, 2)], "vl_ano string, vl_qtd int, cdg int")
    assert tables.typed(df).dtypes == [("vl_ano", "int"), ("vl_qtd", "decimal(38,8)"), ("cdg", "int")]


def test_read_back_of_a_missing_table_is_empty(spark):
    empty = tables.read_back(spark, "nunca gravada", "a int, b string")
    assert empty.isEmpty() and empty.columns == ["a", "b"]
    assert tables.read_many(spark, ["nunca gravada"]) == {}


def test_read_through_builds_only_once(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(4)

    name = f"guardado {id(calls)}"
    assert tables.read_through(spark, name, build).count() == 4
    assert tables.read_through(spark, name, build).count() == 4
    assert len(calls) == 1
    tables.read_through(spark, name, build, force=True)
    assert len(calls) == 2


def test_refresh_stores_audits_and_survives_failures(spark):
    trail = work_path(spark, "auditoria")
    rows = spark.createDataFrame([("a", 1.5, 2025), (None, None, 2026)], "nm_acao string, vl_x double, vl_ano int")
    builders = {
        "boa": lambda: rows,
        "vazia": lambda: rows.limit(0),
        "ruim": lambda: rows.select("nada"),
        "outra": lambda: rows,
    }
    assert refresh_all(builders, "2026-01-02 03:04:05", trail) == {"boa": "fin_boa", "outra": "fin_outra"}
    audit = spark.read.parquet(trail).orderBy("nome_processo").collect()
    assert [(r.nome_processo, r.total_linhas, r.total_colunas, r.total_nulos) for r in audit] == [
        ("boa", 2, 3, 2), ("outra", 2, 3, 2),
    ]
    details = json.loads(audit[0].detalhes_json)
    assert details["kpis_gerais"] == {"total_linhas": 2, "total_colunas": 3}
    assert details["estatisticas_numericas"]["vl_ano"] == {
        "soma_total": 4051.0, "media": 2025.5, "maximo": 2026.0, "minimo": 2025.0,
    }
    assert refresh_all({"seca": lambda: rows}, "2026-01-02 03:04:05", trail, load=False) == {}
    assert tables.read_back(spark, "seca").columns == []


def test_fund_refresh_audits_its_indicators(spark):
    trail = work_path(spark, "auditoria")
    fund = spark.createDataFrame([("a.1) x", "1,50"), ("b.2) y", "2,00")], "Descricao string, Valor_Str string")
    refresh_all({"fidc": lambda: fund}, "2026-01-02 03:04:05", trail)
    details = json.loads(spark.read.parquet(trail).first().detalhes_json)
    assert details["kpis_gerais"] == {
        "total_linhas": 2, "total_colunas": 2, "soma_inadimplentes_ate_360_dias": 1.5,
        "soma_pagos_antecipadamente_ate_360_dias": 2.0, "soma_total": 3.5,
    }
    assert "estatisticas_numericas" not in details


def test_null_cells_of_a_wide_table(spark):
    wide = spark.range(3).select(*[F.when(F.col("id") > 0, F.col("id")).alias(f"c{n}") for n in range(400)])
    assert quality.quality_metrics(wide).first()["total_nulos"] == 400


def test_unfinished_versions_are_not_read(spark):
    assert tables.read_back(spark, "some ida").columns == []
    spark.range(2).write.parquet(tables.new_version(spark, "some ida"))
    assert tables.read_back(spark, "some ida").columns == []
    tables.load_replace(spark.range(3), "some ida")
    spark.range(9).write.parquet(tables.new_version(spark, "some ida"))
    assert tables.read_back(spark, "some ida").count() == 3


def test_old_versions_go_when_asked(spark):
    for n in (1, 2, 3):
        tables.load_replace(spark.range(n), "muitas versoes")
    assert len(tables.retain(spark, "muitas versoes", keep=1)) == 2
    assert tables.read_back(spark, "muitas versoes").count() == 3
    assert tables.retain(spark, "muitas versoes", keep=1) == []


def test_stored_tables_outlive_the_session(spark):
    tables.load_replace(spark.range(5), "duradoura")
    code = (
        "from saldo.session import build_session\nfrom saldo.sources import tables\n"
        f"s = build_session('local[1]', **{{'spark.saldo.tables.dir': {tables_dir(spark)!r}, 'spark.ui.enabled': 'false'}})\n"
        "print('ROWS', tables.read_back(s, 'duradoura').count(), tables.read_through(s, 'duradoura', lambda: 1 / 0).count())"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180, cwd=ROOT)
    assert "ROWS 5 5" in done.stdout, done.stderr[-2000:]


def test_standardized_leaves_out_empty_and_broken(spark):
    rows = spark.createDataFrame([("x",)], "CC string")
    ready = standardized({"A": lambda: rows, "b": lambda: rows.limit(0), "c": lambda: 1 / 0}, ["a", "B", "c"])
    assert list(ready) == ["A"] and ready["A"].columns == ["nm_cc"]


def test_json_files_per_section(spark):
    path = work_path(spark, "json")
    tables.write_json(tables.json_records(mensal=spark.range(2), projeto=spark.range(1)), path)
    back = spark.read.text(path)
    assert sorted((r.secao, r.value) for r in back.collect()) == [
        ("mensal", '{"id":0}'), ("mensal", '{"id":1}'), ("projeto", '{"id":0}'),
    ]


def test_relational_scan_options(spark, monkeypatch):
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **given):
            seen.update(given)
            return self

        def load(self):
            return "frame"

    class Session:
        read = Reader()

    assert relational.read_relational(Session(), "jdbc:x", "t", "id", ("1", "9"), 4) == "frame"
    assert seen["format"] == "jdbc" and seen["numPartitions"] == "4" and seen["upperBound"] == "9"
    with pytest.raises(ValueError):
        relational.read_relational(Session(), "jdbc:x", "t", "id")


def test_reference_list_keeps_leading_zeros(spark, tmp_path):
    (tmp_path / "anos.csv").write_text("cc,ano\n00160.000002.018,2025\n")
    row = relational.read_list(spark, str(tmp_path / "anos.csv"), "cc string, ano string").first()
    assert tuple(row) == ("00160.000002.018", "2025")


def test_statistics_of_ids_near_the_limit_of_their_type(spark, tmp_path):
    big = spark.range(4).select((F.lit(9_000_000_000_000_000_000) + F.col("id")).alias("cdg_id"))
    row = quality.numeric_stats(big).first()
    assert row.soma_total == pytest.approx(3.6e19) and row.maximo == pytest.approx(9e18)
    metrics = tables.store_with_metrics(big, "ids grandes")
    assert metrics["total_linhas"] == 4 == tables.read_back(spark, "ids grandes").count()


def test_a_count_that_differs_from_the_stored_rows_fails(spark, monkeypatch):
    monkeypatch.setattr(tables, "metric_columns", lambda df: [F.lit(7).alias("x"), F.max(F.lit(2)).alias("total_linhas")])
    with pytest.raises(RuntimeError, match="stored but"):
        tables.store_with_metrics(spark.range(5), "contagem errada")


def test_fund_amounts_keep_all_places(spark):
    rows = spark.createDataFrame([("a.1) x", "0.004")] * 3 + [("b.2) y", "12345678901234567890.5")], "nm_descricao string, v string")
    got = quality.fund_kpis(rows.withColumn("vl_valor", F.col("v").cast("decimal(38,8)"))).first()
    assert str(got[0]) == "0.01200000" and str(got[1]) == "12345678901234567890.50000000"
