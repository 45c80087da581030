"""Delinquency studies on the standardised receivables table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.functions.dates import in_years
from saldo.functions.numbers import MONEY, as_amount, percent
from saldo.functions.ranking import first_rows, number_rows
from saldo.functions.text import id_text
from saldo.operators.mappings import (
    AUDIT_NAMES,
    IMPACT_NAMES,
    OPEN,
    OUTLIER_CHANNELS,
    PAID,
    PAID_LATE,
    PAID_ON_TIME,
    STILL_OPEN,
    TOP_OPEN_NAMES,
)

DATES = ["dt_datavencimento", "dt_databaixa", "dt_datacriacao"]
AMOUNTS = ["vl_valororiginal", "vl_valorbaixado"]
PERIOD = ["ano_venc", "mes_venc"]
OTHER_CHANNELS = "outros"


def delinq_base(receivables: DataFrame, years: list[int]) -> DataFrame:
    """Normalised instalments due in the given years.

    Unreadable amounts are 0, the invoice id is text, and the gross amount is
    the original one where the table has no gross column.
    """
    gross = "vl_bruto" if "vl_bruto" in receivables.columns else "vl_valororiginal"
    due_kept = receivables.filter(in_years("dt_datavencimento", years))
    clean = due_kept.withColumns(
        {c: F.col(c).cast("timestamp") for c in DATES}
        | {c: as_amount(c) for c in AMOUNTS}
        | {"vl_bruto": as_amount(gross), "cdg_idmov": id_text("cdg_idmov")}
    )
    return clean.withColumns(
        {
            "ano_venc": F.year("dt_datavencimento"),
            "mes_venc": F.month("dt_datavencimento"),
        }
    )


def _late(limit: Column) -> Column:
    paid, due = F.col("dt_databaixa"), F.col("dt_datavencimento")
    return F.coalesce(paid > due, F.lit(False)) | F.coalesce(
        paid.isNull() & (due < limit), F.lit(False)
    )


def _says_paid() -> Column:
    return F.lower(F.trim("nm_descstatuslcto")) == PAID.lower()


def delinq_flags(base: DataFrame, as_of: str, old_year: int) -> DataFrame:
    """Cut-off, delinquency flag and status, each year seen from its own date.

    Instalments of the old year are judged one year before ``as_of``, so that
    both years are equally old when compared.
    """
    now = F.lit(as_of).cast("timestamp")
    cut = F.when(F.col("ano_venc") == old_year, now - F.expr("interval 1 year")).otherwise(now)
    limit = F.col("data_limite_corte")
    return (
        base.withColumn("data_limite_corte", cut)
        .withColumn("is_inadimplente", _late(limit))
        .withColumn(
            "status_simplificado",
            F.when(_says_paid() & (F.col("dt_databaixa") <= limit), PAID).otherwise(OPEN),
        )
    )


def delinq_flags_now(base: DataFrame, as_of: str) -> DataFrame:
    """Delinquency flag and status as of one moment for all years."""
    return base.withColumn("is_inadimplente", _late(F.lit(as_of).cast("timestamp"))).withColumn(
        "status_simplificado", F.when(_says_paid(), PAID).otherwise(OPEN)
    )


def delinq_daily(base: DataFrame, first: str, last: str) -> DataFrame:
    """(tipo_mov, dia, parcelas, valor): the open and late instalments of every channel on every day.

    What ``delinq_flags`` says of one cut-off, for the midnight of each day from ``first`` to
    ``last``. Every instalment is late and open over one span of days, so it gives at most two
    events, which are summed by channel and day before they are shuffled; running sums over a
    channel's days then hold the balance. An instalment paid late counts from the first day on,
    as its flag does not look at the cut-off. Rows without channel are a channel of their own.
    """
    due, paid = F.to_date("dt_datavencimento"), F.col("dt_databaixa")
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    # the first midnight that is not before the payment
    settled = F.when(paid > F.to_date(paid).cast("timestamp"), F.date_add(F.to_date(paid), 1)).otherwise(F.to_date(paid))
    begins = F.when(paid > F.col("dt_datavencimento"), low).when(paid.isNull(), F.date_add(due, 1))
    ends = F.when(paid.isNotNull() & F.coalesce(_says_paid(), F.lit(False)), settled)
    spans = base.select(
        F.col("cdg_codtmv").alias("tipo_mov"), F.col("vl_valororiginal").alias("_valor"),
        F.greatest(begins, low).alias("_de"), ends.alias("_ate"), begins.isNull().alias("_nunca"),
    ).filter(~F.col("_nunca") & (F.col("_ate").isNull() | (F.col("_de") < F.col("_ate"))) & (F.col("_de") <= high))
    event = F.array(
        F.struct(F.col("_de").alias("dia"), F.lit(1).alias("_sinal")),
        F.struct(F.col("_ate").alias("dia"), F.lit(-1).alias("_sinal")),
    )
    events = spans.select("tipo_mov", "_valor", F.inline(event)).filter(F.col("dia") <= high)
    signed = (F.col("_sinal") * F.col("_valor")).cast(MONEY)
    daily = events.groupBy("tipo_mov", "dia").agg(
        F.sum("_sinal").alias("parcelas"), F.sum(signed).cast(MONEY).alias("valor")
    )
    nothing = [F.lit(0).cast("bigint").alias("parcelas"), F.lit(0).cast(MONEY).alias("valor")]
    days = base.select(F.col("cdg_codtmv").alias("tipo_mov")).distinct()
    days = days.select("tipo_mov", F.explode(F.sequence(low, high)).alias("dia"), *nothing)
    filled = daily.unionByName(days).groupBy("tipo_mov", "dia").agg(F.sum("parcelas").alias("_n"), F.sum("valor").alias("_v"))
    until = Window.partitionBy("tipo_mov").orderBy("dia").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return filled.select(
        "tipo_mov", "dia", F.sum("_n").over(until).alias("parcelas"), F.sum("_v").over(until).cast(MONEY).alias("valor")
    )


def created_in_time(flags: DataFrame) -> DataFrame:
    """Instalments of a channel that were created by the cut-off."""
    return flags.filter(
        (F.col("dt_datacriacao") <= F.col("data_limite_corte")) & F.col("cdg_codtmv").isNotNull()
    )


def invoice_numbers(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(cdg_idmov, numero): each invoice with a number of its own, counted from 0 without gaps.

    Numbers follow the invoices' first creation, so those of one month lie close together
    and their bitmaps are few. ``known`` is an earlier result; its numbers stay and new
    invoices go on after them.
    """
    fresh = rows.groupBy("cdg_idmov").agg(F.min("dt_datacriacao").alias("_criada"))
    start = 0
    if known is not None:
        fresh = fresh.join(known.select("cdg_idmov"), "cdg_idmov", "left_anti")
        start = known.agg(F.coalesce(F.max("numero") + 1, F.lit(0))).first()[0]
    numbered = number_rows(fresh, "numero", F.asc("_criada"), F.asc("cdg_idmov"))
    numbered = numbered.select("cdg_idmov", (F.col("numero") + (start - 1)).alias("numero"))
    return numbered if known is None else known.select("cdg_idmov", "numero").unionByName(numbered)


def invoice_bitmaps(flags: DataFrame, numbers: DataFrame) -> DataFrame:
    """(mes, tipo_mov, ano_venc, bloco, bits): the invoices of each cell as bitmaps of their numbers.

    This is the state to store for each month of loads: bitmaps of one cell are merged by OR,
    within and across loads, and never count an invoice twice.
    """
    rows = created_in_time(flags).select(
        F.month("dt_datacriacao").alias("mes"), F.col("cdg_codtmv").alias("tipo_mov"), "ano_venc", "cdg_idmov"
    )
    numbered = rows.join(numbers, "cdg_idmov")
    # Spark counts buckets from 1 and has no bit for negative numbers; ours begin at 0
    place = F.col("numero") + 1
    return numbered.groupBy("mes", "tipo_mov", "ano_venc", F.bitmap_bucket_number(place).alias("bloco")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )


def count_bitmaps(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """Distinct invoices (``notas``) by some of the bitmaps' columns, exact for any choice of them."""
    merged = bitmaps.groupBy(*by, "bloco").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = merged.groupBy(*by) if by else merged.groupBy()
    return counted.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("bigint").alias("notas"))


def invoices_from_bitmaps(bitmaps: DataFrame, old: int, new: int) -> DataFrame:
    """``invoices_by_channel`` from the stored bitmaps."""
    counts = count_bitmaps(bitmaps, ["mes", "tipo_mov", "ano_venc"])
    return counts.groupBy("mes", "tipo_mov").pivot("ano_venc", [old, new]).agg(F.sum("notas")).fillna(0).orderBy("mes", "tipo_mov")


def invoices_by_channel(flags: DataFrame, old: int, new: int) -> DataFrame:
    """Distinct invoices by creation month and channel, both years side by side.

    Only instalments created by the cut-off count. Missing combinations are 0.
    """
    cohort = created_in_time(flags)
    return (
        cohort.groupBy(
            F.month("dt_datacriacao").alias("mes"), F.col("cdg_codtmv").alias("tipo_mov")
        )
        .pivot("ano_venc", [old, new])
        .agg(F.count_distinct("cdg_idmov"))
        .fillna(0)
        .orderBy("mes", "tipo_mov")
    )


def invoices_no_outlier(counts: DataFrame, outliers: list[str] = OUTLIER_CHANNELS) -> DataFrame:
    """The same table without the outlier channels."""
    return counts.filter(~F.col("tipo_mov").isin(outliers))


def channel_matrix(
    table: DataFrame, old: int, new: int, channels: list[str] | None = None
) -> DataFrame:
    """Year and month by channel, one column per channel, missing cells 0.

    With a list of channels all others are summed in ``canal_outros``, which is
    missing only when the list is. Without a list Spark looks the channels up and
    refuses more than ``spark.sql.pivotMaxValues`` of them.
    """
    years = F.array(
        *[F.struct(F.lit(y).alias("ano"), F.col(f"`{y}`").alias("_valor")) for y in (old, new)]
    )
    long = table.select("mes", "tipo_mov", F.inline(years))
    if channels is not None:
        listed = F.coalesce(F.col("tipo_mov").isin(channels), F.lit(False))
        long = long.withColumn("tipo_mov", F.when(listed, F.col("tipo_mov")).otherwise(F.lit(OTHER_CHANNELS)))
        channels = [*channels, OTHER_CHANNELS]
    wide = long.groupBy("ano", "mes").pivot("tipo_mov", channels).agg(F.sum("_valor"))
    names = ["canal_" + re.sub(r"\W", "_", c) for c in wide.columns[2:]]
    return wide.toDF("ano", "mes", *names).fillna(0)


def open_by_channel(flags: DataFrame, old: int, new: int) -> DataFrame:
    """Open amount by due month and channel, both years side by side."""
    still = flags.filter((F.col("status_simplificado") == OPEN) & F.col("cdg_codtmv").isNotNull())

    def of(year: int) -> Column:
        amount = F.sum(F.when(F.col("ano_venc") == year, F.col("vl_valororiginal")))
        return F.coalesce(amount, F.lit(0)).alias(str(year))

    return (
        still.filter(F.col("ano_venc").isin(old, new))
        .groupBy(F.col("mes_venc").alias("mes"), F.col("cdg_codtmv").alias("tipo_mov"))
        .agg(of(old), of(new))
        .orderBy("mes", "tipo_mov")
    )


def channel_impact(flags: DataFrame) -> DataFrame:
    """Open total, largest instalment and count by year and channel, under display names."""
    still = flags.filter((F.col("status_simplificado") == OPEN) & F.col("cdg_codtmv").isNotNull())
    return (
        still.groupBy("ano_venc", "cdg_codtmv")
        .agg(
            F.sum("vl_valororiginal").alias("valor_total_em_aberto"),
            F.max("vl_valororiginal").alias("maior_boleto_individual"),
            F.count("cdg_idlan").alias("quantidade_de_parcelas"),
        )
        .orderBy("ano_venc", F.desc("valor_total_em_aberto"))
        .withColumnsRenamed(IMPACT_NAMES)
    )


def top_open(flags: DataFrame, n: int = 10) -> DataFrame:
    """The largest open instalments of each year by gross amount.

    Ties go to the lower instalment id, then to the other shown columns.
    """
    still = flags.filter(F.col("status_simplificado") == OPEN)
    rest = [c for c in TOP_OPEN_NAMES if c != "vl_bruto"]
    top = first_rows(still, n, ["ano_venc"], F.desc("vl_bruto"), F.asc("cdg_idlan"), *rest)
    return top.select("ano_venc", "posicao", *TOP_OPEN_NAMES).withColumnsRenamed(TOP_OPEN_NAMES)


def _timeline(base: DataFrame, value: Column) -> DataFrame:
    paid, due = F.col("dt_databaixa"), F.col("dt_datavencimento")
    behaviour = F.when(paid <= due, PAID_ON_TIME).when(paid > due, PAID_LATE).otherwise(STILL_OPEN)
    label = F.concat(F.col("mes_venc").cast("string"), F.lit("/"), F.col("ano_venc").cast("string"))
    return (
        base.groupBy(
            (F.col("ano_venc") * 100 + F.col("mes_venc")).alias("periodo_ordenado"),
            label.alias("periodo_nome"),
        )
        .agg(
            *[
                F.coalesce(F.sum(F.when(behaviour == c, value)), F.lit(0)).alias(c)
                for c in (PAID_ON_TIME, PAID_LATE, STILL_OPEN)
            ]
        )
        .orderBy("periodo_ordenado")
    )


def cash_timeline(base: DataFrame) -> DataFrame:
    """Amount per due month: paid on time, paid late, still open."""
    return _timeline(base, F.col("vl_valororiginal"))


def count_timeline(base: DataFrame) -> DataFrame:
    """Number of instalments per due month in the same classes."""
    return _timeline(base, F.when(F.col("cdg_idlan").isNotNull(), 1).otherwise(0))


def _share(part: str, whole: str) -> Column:
    """Percent to two places, halves to even on the hundredfold value."""
    return F.rint(percent(F.col(part), F.col(whole)) * 100) / 100


def share_by_count(flags: DataFrame) -> DataFrame:
    """Paid and open share of the instalments per due month."""

    def counted(status: str, name: str) -> Column:
        return F.count(F.when(F.col("status_simplificado") == status, F.col("cdg_idlan"))).alias(name)

    return (
        flags.groupBy(*PERIOD)
        .agg(
            counted(PAID, "qtd_baixado"),
            counted(OPEN, "qtd_aberto"),
            F.count("cdg_idlan").alias("total_parcelas"),
        )
        .withColumn("pct_baixado_qtd", _share("qtd_baixado", "total_parcelas"))
        .withColumn("pct_aberto_qtd", _share("qtd_aberto", "total_parcelas"))
        .orderBy(*PERIOD)
    )


def _per_invoice(flags: DataFrame, paid_only: bool) -> DataFrame:
    """One row per due month and invoice: gross counted once, paid and open summed.

    The gross amount is that of the lowest instalment id. All parts are hash
    aggregates, so the invoices without id, which share one key, combine
    inside each task.
    """
    is_paid = F.col("status_simplificado") == PAID
    paid = F.when(is_paid, F.col("vl_valorbaixado")) if paid_only else F.col("vl_valorbaixado")
    still = F.when(F.col("status_simplificado") == OPEN, F.col("vl_valororiginal"))
    return flags.groupBy(*PERIOD, "cdg_idmov").agg(
        F.coalesce(F.min_by("vl_bruto", "cdg_idlan"), F.min("vl_bruto")).alias("_bruto"),
        F.sum(paid).alias("_baixado"),
        F.sum(still).alias("_aberto"),
    )


def gross_dedup(flags: DataFrame) -> DataFrame:
    """Gross amount per due month with each invoice counted once."""
    return (
        _per_invoice(flags, paid_only=False)
        .groupBy(*PERIOD)
        .agg(F.sum("_bruto").alias("total_faturamento_bruto"))
    )


def share_by_value(flags: DataFrame, paid_only: bool = False) -> DataFrame:
    """Paid and open share of the de-duplicated gross amount per due month."""
    return (
        _per_invoice(flags, paid_only)
        .groupBy(*PERIOD)
        .agg(
            F.sum("_bruto").alias("total_faturamento_bruto"),
            F.coalesce(F.sum("_baixado"), F.lit(0)).alias("valor_baixado"),
            F.coalesce(F.sum("_aberto"), F.lit(0)).alias("valor_aberto"),
        )
        .withColumn("pct_baixado_val", _share("valor_baixado", "total_faturamento_bruto"))
        .withColumn("pct_aberto_val", _share("valor_aberto", "total_faturamento_bruto"))
        .orderBy(*PERIOD)
    )


def delinquent(flags: DataFrame) -> DataFrame:
    """The delinquent instalments."""
    return flags.filter("is_inadimplente")


def delinq_share_count(flags: DataFrame) -> DataFrame:
    """Paid and open share by count among the delinquent instalments."""
    return share_by_count(delinquent(flags))


def delinq_share_value(flags: DataFrame) -> DataFrame:
    """Paid-late and open share by value among the delinquent instalments."""
    return share_by_value(delinquent(flags), paid_only=True)


def delinq_audit(flags: DataFrame, old: int, new: int, n: int = 100) -> DataFrame:
    """Audit lists: delinquents of each year, and those of the new year paid late.

    Every list shows its first ``n`` instalments by gross amount and the size
    of the whole list.
    """
    recent = F.col("ano_venc") == new
    lists = F.array_compact(
        F.array(
            F.when(F.col("ano_venc") == old, F.lit(f"inadimplentes_{old}")),
            F.when(recent, F.lit(f"inadimplentes_{new}")),
            F.when(recent & (F.col("status_simplificado") == PAID), F.lit(f"pagos_com_atraso_{new}")),
        )
    )
    members = delinquent(flags).select("*", F.explode(lists).alias("lista"))
    rest = [c for c in AUDIT_NAMES if c != "vl_bruto"]
    order = [F.desc("vl_bruto"), F.asc("cdg_idlan"), *rest]
    narrow = members.select("lista", "cdg_idlan", *[c for c in AUDIT_NAMES if c != "cdg_idlan"])
    shown = first_rows(narrow, n, ["lista"], *order)
    sizes = members.groupBy("lista").agg(F.count(F.lit(1)).alias("total"))
    return (
        shown.join(F.broadcast(sizes), "lista")
        .select("lista", "posicao", "total", *AUDIT_NAMES)
        .withColumnsRenamed(AUDIT_NAMES)
    )
