"""Year-on-year tables, scales and rankings on the report totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.functions.numbers import change_percent, half_up
from saldo.functions.ranking import number_rows
from saldo.operators.mappings import MONTH_NAMES
from saldo.operators.planactual import NATURE
from saldo.session import ensure_checkpoint_dir

NAME_LENGTH = 20


def _only(df: DataFrame, column: str, unit: str | None) -> DataFrame:
    return df if unit is None else df.filter(F.col(column) == unit)


def _of_year(year_column: str, year: int, value: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col(year_column) == year, F.col(value))), F.lit(0))


def units(month_totals: DataFrame) -> DataFrame:
    """Distinct units in order."""
    return month_totals.select("nm_unidade").distinct().orderBy("nm_unidade")


def unit_month_series(month_totals: DataFrame, years: list[int], unit: str | None = None) -> DataFrame:
    """Months in order with their name, amounts to whole units; one or all units."""
    names = F.create_map(*[F.lit(x) for pair in MONTH_NAMES.items() for x in pair])
    rows = _only(month_totals, "nm_unidade", unit).filter(F.col("vl_ano").isin(years))
    return rows.select(
        "nm_unidade",
        "vl_ano",
        "vl_mes",
        F.coalesce(names[F.col("vl_mes")], F.concat(F.lit("Mês "), F.col("vl_mes").cast("string"))).alias("nome"),
        half_up(F.col("planejado")).alias("planejado"),
        half_up(F.col("executado")).alias("executado"),
    ).orderBy("nm_unidade", "vl_ano", "vl_mes")


def project_yoy(project_totals: DataFrame, old: int, new: int, unit: str | None = None) -> DataFrame:
    """Both years of each project side by side with the change in percent."""
    wide = _only(project_totals, "nm_unidade", unit).groupBy("nm_unidade", "nm_iniciativa").agg(
        *[
            _of_year("vl_ano", year, value).alias(f"{value}_{year}")
            for year in (old, new)
            for value in ("planejado", "executado")
        ]
    )
    change = {
        f"var_{value}": change_percent(F.col(f"{value}_{old}"), F.col(f"{value}_{new}"))
        for value in ("planejado", "executado")
    }
    return wide.withColumns(change).orderBy("nm_unidade", "nm_iniciativa")


def nature_yoy(nature_totals: DataFrame, old: int, new: int, unit: str | None = None) -> DataFrame:
    """Executed amount of both years per nature, change, largest old year first."""
    wide = _only(nature_totals, "nm_unidade", unit).groupBy("nm_unidade", NATURE).agg(
        *[half_up(_of_year("vl_ano", y, "executado")).alias(f"executado_{y}") for y in (old, new)]
    )
    cut = F.concat(F.left(NATURE, F.lit(NAME_LENGTH)), F.lit("..."))
    return wide.select(
        "nm_unidade",
        F.when(F.length(NATURE) > NAME_LENGTH, cut).otherwise(F.col(NATURE)).alias("nome"),
        F.col(NATURE).alias("nome_completo"),
        f"executado_{old}",
        f"executado_{new}",
        change_percent(F.col(f"executado_{old}"), F.col(f"executado_{new}")).alias("delta"),
    ).orderBy(F.desc(f"executado_{old}"), "nm_unidade", "nome_completo")


def nature_scaled(natures: DataFrame, old: int, new: int) -> DataFrame:
    """Position of both years relative to the unit's largest value, which is at least 1.

    The maximum is an aggregate per unit joined back, so no unit's natures
    have to meet in one task. Both sides read one checkpoint of the table.
    """
    ensure_checkpoint_dir(natures.sparkSession)
    natures = natures.checkpoint()
    top = natures.groupBy("nm_unidade").agg(
        F.greatest(F.max(F.greatest(f"executado_{old}", f"executado_{new}")), F.lit(1)).alias("_topo")
    )
    return natures.join(top, "nm_unidade").select(
        "nm_unidade",
        "nome_completo",
        *[
            (F.col(f"executado_{y}").cast("double") / F.col("_topo") * 100).alias(f"posicao_{y}")
            for y in (old, new)
        ],
    )


def coverage_unit(coverages: DataFrame, old: int, new: int, unit: str | None = None) -> DataFrame:
    """Two-year coverage per unit, absent years as 0, percent to 2 places."""

    def of(year: int, value: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("ano") == year, F.col(value))), F.lit(0.0))

    rows = _only(coverages.filter(F.col("unidade").isNotNull()), "unidade", unit)
    cells = []
    for year in (old, new):
        cells += [
            F.floor(of(year, "despesa") + 0.5).alias(f"despesa_{year}"),
            F.floor(of(year, "receita") + 0.5).alias(f"receita_{year}"),
            F.round(of(year, "indice_cobertura"), 2).alias(f"cobertura_{year}"),
        ]
    return rows.groupBy("unidade").agg(*cells)


def coverage_ranking(coverages: DataFrame, old: int, new: int) -> DataFrame:
    """Units by coverage of the newer year with position and change in points."""

    def of(year: int) -> Column:
        at = F.max(F.when(F.col("ano") == year, F.col("indice_cobertura")))
        return F.coalesce(at, F.lit(0.0)).alias(f"cobertura_{year}")

    wide = coverages.groupBy("unidade").agg(of(old), of(new))
    before, after = F.col(f"cobertura_{old}"), F.col(f"cobertura_{new}")
    wide = wide.withColumn("variacao", F.when(before > 0, after - before).otherwise(F.lit(0.0)))
    return number_rows(wide, "posicao", after.desc(), F.col("unidade").asc())
