import base64

import pytest
from pyspark.sql import functions as F

from saldo.sources import cubes, funds

PAGE = """<html><body><table><tr><td>
<table><tr><td colspan=2><b>V - Comportamento da Carteira</b></td></tr>
<tr><td> a.1) Vencidos &amp; n&atilde;o pagos </td><td>x<span class="outro dado-valores"> R$ 1.234,56 </span></td></tr>
<tr><td>b.1) sem valor</td><td>-</td></tr>
<tr><td>uma c&eacute;lula</td></tr>
</table></td></tr></table>
<table><tr><td>fora</td><td><span class="dado-valores">9</span></td></tr></table></body></html>"""


def test_rows_of_the_innermost_table_with_the_heading():
    assert funds.table_rows(PAGE) == [("a.1) Vencidos & não pagos", "1.234,56"), ("b.1) sem valor", "")]


@pytest.mark.parametrize("page", ["<table><tr><td>x</td></tr></table>", "<b>V - Comportamento da Carteira</b>",
                                  "<table><tr><td><b>V - Comportamento da Carteira</b></td></tr></table>"])
def test_pages_without_the_table_are_errors(page):
    with pytest.raises(ValueError):
        funds.table_rows(page)


def _documents(spark):
    def encoded(text, spoil=b""):
        return base64.b64encode(text.encode() + spoil).decode()

    rows = [
        (1, "f", "Informe Mensal Estruturado", "09/2025", encoded(PAGE)),
        (2, "f", " Informe Mensal Estruturado ", "09/2025", encoded(PAGE.replace("1.234,56", "7,00"), b"\xff")),
        (3, "f", "Outro", "09/2025", encoded("x")),
        (4, "g", "Informe Mensal Estruturado", "08/2025", encoded(PAGE)),
    ]
    return spark.createDataFrame(rows, "id long, fundo string, tipo_documento string, data_referencia string, content string")


def test_latest_report_per_fund_and_month(spark):
    documents = _documents(spark)
    assert sorted(r.id for r in funds.select_fund_documents(documents).collect()) == [2, 4]
    wanted = spark.createDataFrame([("f", "09/2025"), ("g", "09/2025")], "fundo string, data_referencia string")
    assert [r.id for r in funds.select_fund_documents(documents, wanted).collect()] == [2]
    with pytest.raises(Exception, match="no report for g 09/2025"):
        funds.select_fund_documents(documents, wanted, required=True).collect()


def test_extracted_rows(spark):
    rows = funds.fund_table_extract(_documents(spark)).orderBy("id", "linha").collect()
    assert [(r.fundo, r.id, r.linha, r.valor_str) for r in rows] == [
        ("f", 2, 1, "7,00"), ("f", 2, 2, ""), ("g", 4, 1, "1.234,56"), ("g", 4, 2, ""),
    ]


def test_bad_bytes_are_replaced(spark):
    df = spark.createDataFrame([(base64.b64encode(b"ok\xffok").decode(),)], "c string")
    assert df.select(funds.page_text("c")).first()[0] == "ok�ok"


def test_slice_period_and_empty_groups(spark):
    fact = spark.createDataFrame(
        [("e", 2024, 12, 1, "a"), ("e", 2025, 2, 2, "a"), ("e", 2025, 3, 4, "a"), ("o", 2025, 3, 8, "a"), ("e", 2025, 3, None, "b"), ("e", 2026, 1, 16, "a")],
        "entidade string, vl_ano int, vl_mes int, valor int, nivel string",
    )
    period = cubes.months_between("vl_ano", "vl_mes", 202502, 202512)
    got = cubes.cube_slice(fact, ["nivel"], "valor", "soma", period, {"entidade": "e"}).collect()
    assert [tuple(r) for r in got] == [("a", 6)]
    everyone = cubes.cube_slice(fact, ["entidade"], "valor", "soma").orderBy("entidade").collect()
    assert [tuple(r) for r in everyone] == [("e", 23), ("o", 8)]
    with pytest.raises(ValueError):
        cubes.BUDGET_EXPENSE.read(fact, "valor")


def test_year_range_reaches_the_scan(spark, tmp_path):
    spark.range(10).select((F.col("id") + 2000).cast("int").alias("vl_ano"), F.lit(1).alias("vl_mes"), "id").write.parquet(str(tmp_path / "f"))
    rows = spark.read.parquet(str(tmp_path / "f")).filter(cubes.months_between("vl_ano", "vl_mes", 200301, 200512))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(vl_ano,2003)" in plan and "LessThanOrEqual(vl_ano,2005)" in plan
    assert rows.count() == 3
