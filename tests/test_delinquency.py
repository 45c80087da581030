import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from saldo.operators import delinquency, mappings, receivables, study

AS_OF = "2026-06-30"


def _table(spark, rows):
    return spark.createDataFrame(
        rows,
        "cdg_idlan long, cdg_idmov long, cdg_codtmv string, nm_descstatuslcto string, dt_datavencimento date, "
        "dt_databaixa date, dt_datacriacao date, vl_valororiginal string, vl_valorbaixado string, vl_bruto string, "
        "nm_historico string",
    )


def _line(id_, due, paid=None, status="Em Aberto", invoice=1, channel="2.1.1", amount="100", settled="0", gross="300", created="2025-01-01"):
    day = dt.date.fromisoformat
    return (id_, invoice, channel, status, day(due), day(paid) if paid else None, day(created), amount, settled, gross, "h")


def _flags(spark, *lines):
    base = delinquency.delinq_base(_table(spark, list(lines)), [2025, 2026])
    return delinquency.delinq_flags(base, AS_OF, 2025)


def test_flags_use_each_years_cut(spark):
    flags = _flags(
        spark,
        _line(1, "2026-03-01", "2026-03-01", " BAIXADO "),
        _line(2, "2026-06-30"),
        _line(3, "2026-06-29"),
        _line(4, "2026-03-01", "2026-03-02", "Baixado"),
        _line(5, "2025-06-30"),
        _line(6, "2025-06-29"),
        _line(7, "2025-05-01", "2025-07-15", " BAIXADO "),
        _line(8, "2026-05-01", None, "baixado"),
        _line(9, "2024-05-01"),
    )
    got = {r.cdg_idlan: (r.is_inadimplente, r.status_simplificado) for r in flags.collect()}
    assert got == {
        1: (False, "Baixado"), 2: (False, "Em Aberto"), 3: (True, "Em Aberto"), 4: (True, "Baixado"),
        5: (False, "Em Aberto"), 6: (True, "Em Aberto"), 7: (True, "Em Aberto"), 8: (True, "Em Aberto"),
    }


def test_missing_invoice_ids_count_once(spark):
    flags = _flags(
        spark, _line(1, "2026-01-10", invoice=None), _line(2, "2026-01-11", invoice=None), _line(3, "2026-01-12", invoice=7)
    )
    row = delinquency.invoices_by_channel(flags, 2025, 2026).first()
    assert (row["2025"], row["2026"]) == (0, 2)


def test_base_falls_back_to_the_original_amount(spark):
    table = _table(spark, [_line(1, "2026-01-10", amount="x"), _line(2, "2026-01-10")]).drop("vl_bruto")
    got = {r.cdg_idlan: (r.vl_bruto, r.vl_valororiginal) for r in delinquency.delinq_base(table, [2026]).collect()}
    assert got == {1: (0, 0), 2: (100, 100)}


def test_gross_counts_each_invoice_once(spark):
    flags = _flags(
        spark,
        _line(2, "2026-01-10", gross="999"), _line(1, "2026-01-20", gross="300"),
        _line(3, "2026-02-10", gross="300"), _line(4, "2026-01-10", invoice=2, gross="50"),
    )
    got = {r.mes_venc: r.total_faturamento_bruto for r in delinquency.gross_dedup(flags).collect()}
    assert got == {1: 350, 2: 300}


def test_shares(spark):
    paid = [_line(n, "2026-01-10", "2026-01-05", "Baixado", invoice=n, settled="60") for n in range(1)]
    still = [_line(n, "2026-01-10", invoice=n) for n in range(1, 8)]
    flags = _flags(spark, *paid, *still)
    row = delinquency.share_by_count(flags).first()
    assert (row.pct_baixado_qtd, row.pct_aberto_qtd) == (12.5, 87.5)
    value = delinquency.share_by_value(flags).first()
    assert (value.pct_baixado_val, value.pct_aberto_val) == (2.5, 29.17)
    late = delinquency.delinq_share_count(flags).first()
    assert (late.qtd_baixado, late.qtd_aberto, late.pct_aberto_qtd) == (0, 7, 100.0)


def test_share_rounds_halves_to_even(spark):
    df = spark.createDataFrame([(1, 800), (3, 800)], "a int, b int")
    assert [r[0] for r in df.select(delinquency._share("a", "b")).collect()] == [0.12, 0.38]
    zero = spark.createDataFrame([(1, 0)], "a int, b int")
    assert zero.select(delinquency._share("a", "b")).first()[0] is None


def test_timeline_has_all_classes_and_sums_to_the_base(spark):
    base = delinquency.delinq_base(_table(spark, [_line(1, "2026-01-10"), _line(2, "2025-12-10", "2025-12-10")]), [2025, 2026])
    rows = delinquency.cash_timeline(base).collect()
    assert [r.periodo_nome for r in rows] == ["12/2025", "1/2026"]
    names = [mappings.PAID_ON_TIME, mappings.PAID_LATE, mappings.STILL_OPEN]
    assert [[int(r[n]) for n in names] for r in rows] == [[100, 0, 0], [0, 0, 100]]
    assert sum(r[mappings.STILL_OPEN] for r in delinquency.count_timeline(base).collect()) == 1


def test_channel_tables(spark):
    flags = _flags(
        spark, _line(1, "2026-01-10", channel="2.1.13"), _line(2, "2025-01-10", channel="2.1.2"),
        _line(3, "2026-01-10", channel=None),
    )
    counts = delinquency.invoices_by_channel(flags, 2025, 2026)
    assert [r.tipo_mov for r in delinquency.invoices_no_outlier(counts).collect()] == ["2.1.2"]
    wide = delinquency.channel_matrix(counts, 2025, 2026).orderBy("ano").collect()
    assert [(r.ano, r.mes, r.canal_2_1_13, r.canal_2_1_2) for r in wide] == [(2025, 1, 0, 1), (2026, 1, 1, 0)]
    opened = delinquency.open_by_channel(flags, 2025, 2026).collect()
    assert [(r.tipo_mov, r["2025"], r["2026"]) for r in opened] == [("2.1.13", 0, 100), ("2.1.2", 100, 0)]
    impact = delinquency.channel_impact(flags)
    assert impact.columns == list(mappings.IMPACT_NAMES.values())
    assert impact.count() == 2


def test_top_and_audit_lists(spark):
    lines = [_line(n, "2026-01-10", invoice=n, gross=str(n)) for n in range(1, 151)]
    lines += [_line(200, "2026-01-10", "2026-02-01", "Baixado", gross="500")]
    flags = _flags(spark, *lines)
    top = delinquency.top_open(flags).orderBy("posicao").collect()
    assert [int(r["Valor Total da Fatura (IDMOV)"]) for r in top] == list(range(150, 140, -1))
    audit = delinquency.delinq_audit(flags, 2025, 2026)
    sizes = {r.lista: (r.n, r.total) for r in audit.groupBy("lista").agg(F.count("*").alias("n"), F.max("total").alias("total")).collect()}
    assert sizes == {"inadimplentes_2026": (100, 151), "pagos_com_atraso_2026": (1, 1)}


def _instalments(spark, rows):
    return spark.createDataFrame(
        rows, "id int, datavencimento date, pagrec string, codtdo string, codcxa string, historico string, descstatuslcto string"
    )


@pytest.mark.parametrize(
    "change",
    [
        {"historico": None}, {"codtdo": None}, {"descstatuslcto": None}, {"codcxa": None}, {"codtdo": "030"},
        {"codcxa": "22.420-0"}, {"historico": "DEV. adiantamento  viagem"}, {"descstatuslcto": "CANCELADO"},
    ],
)
def test_unknown_or_excluded_values_drop_the_row(spark, change):
    good = {"id": 1, "datavencimento": dt.date(2025, 5, 1), "pagrec": "1", "codtdo": "010", "codcxa": "c", "historico": "h", "descstatuslcto": "Em Aberto"}
    df = _instalments(spark, [tuple(good.values()), tuple({**good, "id": 2, **change}.values())])
    assert [r.id for r in receivables.receivables_filters(df).collect()] == [1]


def test_due_range_ends_at_the_given_moment(spark):
    day = dt.date
    rows = [(n, d, flag, "010", "c", "h", "s") for n, d, flag in [
        (1, day(2025, 1, 1), "1"), (2, day(2024, 12, 31), "1"), (3, day(2026, 6, 30), "1"), (4, day(2026, 7, 1), "1"), (5, day(2025, 5, 5), "2"),
    ]]
    assert [r.id for r in receivables.due_between(_instalments(spark, rows), "2026-06-30 12:00:00").collect()] == [1, 3]


def _study(spark):
    budget = spark.createDataFrame(
        [(None, 2025, "n1", "N1", 1, Decimal(10)), ("c", 2025, "n1", "N1", 1, Decimal(20)), ("c", 2025, "n2", "N2", 1, Decimal(5)),
         ("c", 2024, "n2", "N2", 1, Decimal(7)), ("d", 2025, "n3", None, 1, Decimal(1))],
        "nm_cc string, vl_ano int, cdg_natorcamentonvl4 string, nm_natorcamentonvl4 string, vl_mes int, vl_ajustado decimal(18,2)",
    )
    fact = spark.createDataFrame(
        [(None, dt.date(2025, 2, 1), Decimal(100)), ("c", dt.date(2025, 2, 1), Decimal(1)), ("c", dt.date(2025, 3, 1), Decimal(2)),
         ("c", dt.date(2024, 3, 1), Decimal(50))],
        "nm_cc string, nm_data date, vl_valor decimal(18,2)",
    )
    others = [c for c in study.LEDGER_COLUMNS if c not in (*fact.columns, "ano_fatos")]
    return budget, fact.withColumns({c: F.lit(c) for c in others})


def test_a_missing_ledger_column_is_an_error(spark):
    budget, fact = _study(spark)
    with pytest.raises(AnalysisException, match="nm_conta"):
        study.budget_ledger_join(budget, fact.drop("nm_conta"), [2025])


def test_missing_cost_centers_match_each_other(spark):
    joined = study.budget_ledger_join(*_study(spark), [2025, 2026])
    assert [int(r.vl_valor) for r in joined.filter("nm_cc is null").collect()] == [100]
    assert joined.count() == 7


def test_nature_totals_equal_the_joined_rows(spark):
    direct = (
        study.budget_ledger_join(*_study(spark), [2025, 2026]).dropna(subset=["nm_natorcamentonvl4"])
        .groupBy("nm_natorcamentonvl4").agg(F.coalesce(F.sum("vl_valor"), F.lit(0)).alias("v"), F.sum("vl_ajustado").alias("a"))
    )
    quick = study.budget_ledger_nature(*_study(spark), [2025, 2026])
    assert sorted(map(tuple, quick.collect())) == sorted(map(tuple, direct.collect()))


def test_top_cost_centers(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 5), (None, 99), ("c", 5)], "nm_cc string, vl_valor int")
    assert [r.nm_cc for r in study.top_cost_centers(fact, 2).collect()] == ["b", "c"]
