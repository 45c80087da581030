"""Cube slices as aggregations over a fact table.

Each slice sums one measure by a fixed set of levels over a range of months,
for one entity or all, and keeps only groups that hold a value. Several slices of one
cube are grouping sets of a single aggregation, so the cube is scanned once for all.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def months_between(year: str, month: str, first: int, last: int) -> Column:
    """Rows from month ``first`` to month ``last``, both written yyyymm.

    The plain year range reaches the scan; the month tests only cut the ends.
    """
    (y0, m0), (y1, m1) = divmod(first, 100), divmod(last, 100)
    inside = F.col(year).between(y0, y1)
    if m0 > 1:
        inside = inside & ((F.col(year) > y0) | (F.col(month) >= m0))
    if m1 < 12:
        inside = inside & ((F.col(year) < y1) | (F.col(month) <= m1))
    return inside


def cube_slice(
    fact: DataFrame,
    levels: list[str],
    measure: str,
    name: str,
    period: Column | None = None,
    members: dict[str, str] | None = None,
) -> DataFrame:
    """Sum ``measure`` by ``levels`` within a period and fixed dimension members.

    ``sum`` combines inside each task first, so a hot level member is one row
    per task when it is shuffled. Groups whose sum is NULL are left out.
    """
    rows = fact if period is None else fact.filter(period)
    for dimension, member in (members or {}).items():
        rows = rows.filter(F.col(dimension) == member)
    return rows.groupBy(*levels).agg(F.sum(measure).alias(name)).filter(F.col(name).isNotNull())


@dataclass(frozen=True)
class Slice:
    """Levels and result name of one published slice, with its default period."""

    levels: list[str]
    name: str
    first: int
    last: int
    snapshot: str | None = None
    one_entity: bool = True

    def rows(self, entity: str | None = None, first: int | None = None, last: int | None = None) -> Column:
        """Which rows of the cube the slice sums."""
        low, high = first or self.first, last or self.last
        if self.one_entity and entity is None:
            raise ValueError(f"slice {self.name} needs the entity")
        inside = F.col(self.snapshot).between(low, high) if self.snapshot else months_between("vl_ano", "vl_mes", low, high)
        return inside & (F.col("entidade") == entity) if self.one_entity else inside

    def read(
        self,
        fact: DataFrame,
        measure: str,
        entity: str | None = None,
        first: int | None = None,
        last: int | None = None,
    ) -> DataFrame:
        """Run the slice on a fact table; period and entity are parameters."""
        return cube_slice(fact, self.levels, measure, self.name, self.rows(entity, first, last))


@dataclass(frozen=True)
class Reading:
    """A slice as one pass over the cube reads it: measure, entity and period."""

    slice: Slice
    measure: str
    entity: str | None = None
    first: int | None = None
    last: int | None = None

    def rows(self) -> Column:
        """Which rows of the cube are summed."""
        return self.slice.rows(self.entity if self.slice.one_entity else None, self.first, self.last)


def cube_slices(fact: DataFrame, readings: Mapping[str, Reading]) -> DataFrame:
    """(fatia, all levels, valor): several slices from one scan of the cube.

    The distinct level lists are the grouping sets; each reading's period and entity are
    a condition inside its sum, so readings with the same levels share a set. Rows that no
    reading wants are left out at the scan. Levels that a slice does not have are NULL,
    and the slice's name tells them from levels that are missing in the cube.
    """
    levels = list(dict.fromkeys(c for r in readings.values() for c in r.slice.levels))
    sets = list(dict.fromkeys(tuple(r.slice.levels) for r in readings.values()))
    wanted = fact.filter(reduce(lambda a, b: a | b, [r.rows() for r in readings.values()]))
    sums = [F.sum(F.when(r.rows(), F.col(r.measure))).alias(f"_soma_{k}") for k, r in enumerate(readings.values())]
    grouped = wanted.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in levels])
    found = grouped.agg(F.grouping_id().alias("_conjunto"), *sums)

    def number(own: list[str]) -> int:
        """The grouping id: one bit a level, set where the level is summed over."""
        return sum((c not in own) << (len(levels) - 1 - k) for k, c in enumerate(levels))

    values = []
    for k, (name, r) in enumerate(readings.items()):
        value = F.when(F.col("_conjunto") == number(r.slice.levels), F.col(f"_soma_{k}"))
        values.append(F.struct(F.lit(name).alias("fatia"), value.alias("valor")))
    return found.select(*levels, F.inline(F.array(*values))).filter(F.col("valor").isNotNull())


def one_slice(found: DataFrame, name: str, slice_: Slice) -> DataFrame:
    """One slice of ``cube_slices`` with the columns that reading it alone gives."""
    return found.filter(F.col("fatia") == name).select(*slice_.levels, F.col("valor").alias(slice_.name))


_PLAN = ["nm_ppa", "nm_unidade", "nm_iniciativa", "nm_acao"]
_NATURE = ["cdg_natorcamentonvl4", "nm_natorcamentonvl4"]

# Levels and default periods (yyyymm) of the eight slices.
BUDGET_EXPENSE = Slice([*_PLAN, *_NATURE, "vl_ano", "vl_mes"], "vl_ajustado", 200801, 202612)
EXECUTED_EXPENSE = Slice([*_PLAN, *_NATURE, "vl_ano", "vl_mes"], "vl_executado", 200801, 202612)
EXECUTED_ENTITIES = Slice(
    ["nm_ppa", "entidade", "nm_iniciativa", "nm_acao", "nm_unidade", *_NATURE, "vl_ano"],
    "vl_executado", 202201, 202612, one_entity=False,
)
REVENUE_INITIATIVE = Slice(
    ["nm_ppa", "nm_unidade", "nm_iniciativa", *_NATURE, "vl_ano", "vl_mes"],
    "vl_ajustado", 202501, 202612,
)
REVENUE_SCENARIO = Slice(["nm_ppa", *_NATURE, "vl_ano", "vl_mes"], "vl_ajustado", 202301, 202612)
# The snapshot range is summed over here: it is in the filter, not in the levels.
ACCOUNT_BALANCE = Slice(
    ["cdg_cdgnvl6", "nm_descnvl6"], "vl_contabilexecutado", 202512, 202606, snapshot="fotografia",
)
EXPENSE_SNAPSHOT = Slice(
    ["fotografia", "nm_iniciativa", "nm_acao", "nm_unidadeacao", "cdg_rm",
     "nm_cdgnatureza", "nm_mes", "nm_ano", "nm_descnvl4"],
    "vl_despesaexecutado", 202401, 202612, snapshot="fotografia",
)
REVENUE_SNAPSHOT = Slice(
    ["fotografia", "nm_iniciativa", "nm_unidadeiniciativa", "nm_cdgnatureza", "nm_descnvl4"],
    "vl_receitaexecutado", 202401, 202606, snapshot="fotografia",
)

