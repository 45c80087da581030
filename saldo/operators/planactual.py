"""Plan against actual: executed ledger amounts next to budgeted ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.functions.dates import in_years
from saldo.functions.joins import lookup_join, skewed_left_join
from saldo.functions.numbers import times_count
from saldo.functions.text import fold_case, folded_in
from saldo.operators.mappings import EXPENSE_GROUPS

KEYS = ["vl_ano", "vl_mes", "nm_iniciativa", "nm_acao", "nm_unidade", "nm_cc", "cdg_natorcamentonvl4"]
# The report joins on these five only; action and unit are not compared, so
# keys that differ in nothing else repeat each other's amounts.
MATCHED = ["vl_ano", "vl_mes", "nm_iniciativa", "nm_cc", "cdg_natorcamentonvl4"]
NATURE = "descricao_natureza_orcamentaria"

BY_MONTH = ["nm_unidade", "vl_ano", "vl_mes"]
BY_NATURE = ["nm_unidade", "vl_ano", NATURE]
BY_PROJECT = ["nm_unidade", "nm_iniciativa", "vl_ano"]
#: Pairs of year and plan that a report may ask for.
MOST_PLAN_YEARS = 10_000
# Names compare without case and trailing blanks; the smallest spelling is shown.
NAMES = ["nm_iniciativa", "nm_acao", "nm_unidade", "nm_cc", "nm_descnvl4", NATURE]


def _compared(key: str, mark: str = "_por_") -> Column:
    """The form in which a key is compared, under a name of its own."""
    return (fold_case(key) if key in NAMES else F.col(key)).alias(mark + key)


def _grouped(df: DataFrame, keys: list[str], *sums: str) -> DataFrame:
    """Groups by the compared form of the keys, each shown in its smallest spelling; forms stay as ``_por_*``.

    Rows are first summed by the spellings as they are, in hash tables. The smallest spelling,
    for which Spark has to sort, is then looked for among those few sums only.
    """
    spelt = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]) if sums else df.select(*keys).distinct()
    shown = [F.min(k).alias(k) for k in keys]
    whole = [F.sum(c).cast(spelt.schema[c].dataType).alias(c) for c in sums]
    return spelt.groupBy(*[_compared(k) for k in keys]).agg(*shown, *whole)


def recode_account(fact: DataFrame, recodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Add budget nature code and description for a ledger account.

    ``recodes`` is (prefixo, natureza), ``labels`` (prefixo, descricao, rotulo);
    what they do not list keeps its own code and description.
    """
    keyed = fact.withColumn("prefixo", F.left("nm_conta", F.lit(7))).withColumn(
        "_descricao", fold_case("nm_descnvl4")
    )
    coded = lookup_join(keyed, recodes, "prefixo")
    named = labels.select("prefixo", fold_case("descricao").alias("_descricao"), "rotulo")
    coded = lookup_join(coded, named, ["prefixo", "_descricao"])
    return (
        coded.withColumn("cdg_natorcamentonvl4", F.coalesce("natureza", "prefixo"))
        .withColumn("nm_descnvl4", F.coalesce("rotulo", "nm_descnvl4"))
        .drop("prefixo", "_descricao", "natureza", "rotulo")
    )


def plan_label(year: Column, labels: dict[int, str]) -> Column:
    """Plan snapshot a year is compared with; NULL for other years."""
    branches = F.lit(None).cast("string")
    for value, label in labels.items():
        branches = F.when(year == value, F.lit(label)).otherwise(branches)
    return branches


def executed_fact(
    fact: DataFrame,
    recodes: DataFrame,
    labels: DataFrame,
    plans: dict[int, str],
    last_month: int = 3,
    groups: list[str] = EXPENSE_GROUPS,
) -> DataFrame:
    """Executed amount by plan, unit, initiative, action, nature, cost centre and month."""
    rows = fact.filter(in_years("nm_data", list(plans), last_month))
    return _executed(rows.withColumn("nm_ppa", plan_label(F.year("nm_data"), plans)), recodes, labels, groups)


def _executed(rows: DataFrame, recodes: DataFrame, labels: DataFrame, groups: list[str]) -> DataFrame:
    """Amounts of rows that have their plan, by its keys."""
    rows = recode_account(rows.filter(folded_in("nm_descnvl1", groups)), recodes, labels).select(
        "nm_ppa",
        "nm_unidade",
        F.col("nm_projeto").alias("nm_iniciativa"),
        "nm_acao",
        "cdg_natorcamentonvl4",
        "nm_descnvl4",
        "nm_cc",
        F.year("nm_data").alias("vl_ano"),
        F.month("nm_data").alias("vl_mes"),
        "vl_valor",
    )
    keys = [c for c in rows.columns if c != "vl_valor"]
    summed = _grouped(rows, keys, "vl_valor")
    return summed.select(*keys, "vl_valor")


def wanted_years(budget: DataFrame, plans: list[str]) -> DataFrame:
    """(ano, nm_ppa): the years that the wanted plans are about, as their budget rows say; few rows, checked."""
    pairs = budget.filter(F.col("nm_ppa").isin(plans)).select(F.col("vl_ano").cast("int").alias("ano"), "nm_ppa").distinct()
    if (n := pairs.count()) > MOST_PLAN_YEARS:
        raise ValueError(f"{n} pairs of year and plan; at most {MOST_PLAN_YEARS} are broadcast")
    return pairs


def executed_in(
    fact: DataFrame,
    wanted: DataFrame,
    recodes: DataFrame,
    labels: DataFrame,
    last_month: int = 3,
    groups: list[str] = EXPENSE_GROUPS,
) -> DataFrame:
    """``executed_fact`` over a fact stored by year (``ano``), for the (ano, nm_ppa) of ``wanted``.

    The years come from a table, not from the program: its pairs are broadcast and prune the
    fact's partitions while the query runs, so years nobody asked for are not opened.
    """
    rows = fact.filter(F.month("nm_data") <= last_month).join(F.broadcast(wanted), "ano")
    return _executed(rows, recodes, labels, groups)


def _key_rows(planned: DataFrame, executed: DataFrame) -> DataFrame:
    return _grouped(planned.select(*KEYS).union(executed.select(*KEYS)), KEYS)


def plan_actual_keys(planned: DataFrame, executed: DataFrame) -> DataFrame:
    """Distinct keys that occur on either side; names that differ in case only are one key."""
    return _key_rows(planned, executed).select(*KEYS)


def _matching(strict: bool) -> list[str]:
    return KEYS if strict else MATCHED


def _zero_if_null(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast(df.schema[column].dataType))


def plan_actual(planned: DataFrame, executed: DataFrame, strict: bool = False) -> DataFrame:
    """Planned and executed amount of every key, row by row.

    Planned rows are not aggregated, so a popular key may hold a large part of
    them. Keys with NULL never match and give 0 and 0. ``strict`` compares all
    seven keys.
    """
    on = _matching(strict)
    keys = _key_rows(planned, executed)
    marked = [f"_por_{k}" for k in on]
    budget = planned.select(
        *[_compared(k, "_p_") for k in on], F.col("nm_natorcamentonvl4").alias("_plano"), "vl_ajustado"
    )
    actual = executed.select(*[_compared(k) for k in on], F.col("nm_descnvl4").alias("_real"), "vl_valor")
    joined = skewed_left_join(keys, budget, {f"_por_{k}": f"_p_{k}" for k in on}).join(actual, marked, "left")
    return joined.select(
        *KEYS,
        F.upper(F.coalesce("_plano", "_real")).alias(NATURE),
        _zero_if_null(joined, "vl_ajustado").alias("vl_ajustado"),
        _zero_if_null(joined, "vl_valor").alias("vl_valor"),
    )


def plan_actual_lines(planned: DataFrame, executed: DataFrame, strict: bool = False) -> DataFrame:
    """The report's amounts per key and nature, without its repeated rows.

    Both sides are summed per key first, and each sum is multiplied by the
    number of rows it would have been repeated for in ``plan_actual``.
    """
    on = _matching(strict)
    scale = planned.schema["vl_ajustado"].dataType.scale
    marked = [f"_por_{k}" for k in on]
    budget = planned.groupBy(*[_compared(k) for k in on], F.col("nm_natorcamentonvl4").alias("_plano")).agg(
        F.sum("vl_ajustado").alias("_planejado"), F.count(F.lit(1)).alias("_planos")
    )
    actual = executed.groupBy(*[_compared(k) for k in on], F.col("nm_descnvl4").alias("_real")).agg(
        F.sum("vl_valor").alias("_executado"), F.count(F.lit(1)).alias("_reais")
    )
    rows = _key_rows(planned, executed).join(budget, marked, "left").join(actual, marked, "left")
    zero, one = F.lit(0).cast(f"decimal(38,{scale})"), F.lit(1)
    planned_sum = times_count(F.coalesce("_planejado", zero), F.coalesce("_reais", one), scale)
    actual_sum = times_count(F.coalesce("_executado", zero), F.coalesce("_planos", one), scale)
    return rows.select(
        *KEYS,
        F.upper(F.coalesce("_plano", "_real")).alias(NATURE),
        planned_sum.alias("planejado"),
        actual_sum.alias("executado"),
    )


def totals(lines: DataFrame, by: list[str]) -> DataFrame:
    """``planejado`` and ``executado`` summed by ``by``, without groups that have a NULL key."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in by])
    return _grouped(lines.filter(present), by, "planejado", "executado").select(*by, "planejado", "executado")


def plan_actual_nested(project_totals: DataFrame) -> DataFrame:
    """Per unit and initiative, JSON year -> planned and executed, from project totals.

    One row is one initiative at every size, so a document grows with the years only.
    """
    amounts = F.struct("planejado", "executado")
    year = F.struct(F.col("vl_ano").cast("string").alias("k"), amounts.alias("v"))
    by_year = F.map_from_entries(F.array_sort(F.collect_list(year)))
    return project_totals.groupBy("nm_unidade", "nm_iniciativa").agg(F.to_json(by_year).alias("anos"))
