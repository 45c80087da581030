"""Budget lines attached to cost centres through names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.functions.joins import lookup_join
from saldo.functions.text import collation_key
from saldo.operators.mappings import CANCELLED_INITIATIVE


def budget_cc_map(year_maps: list[DataFrame], cost_centers: DataFrame) -> DataFrame:
    """Distinct union of the year maps (cc, ano) with the cost-centre names.

    ``ano`` may be text, as the lists carry it; ``cost_centers`` comes from
    ``cost_center_hierarchy``.
    """
    named = [
        years.select("cc", F.col("ano").cast("int").alias("ano")).join(cost_centers, "cc", "left")
        for years in year_maps
    ]
    merged = named[0]
    for part in named[1:]:
        merged = merged.union(part)
    return merged.select("cc", "ano", "projeto", "acao", "unidade").distinct()


def name_keys(cc_map: DataFrame) -> DataFrame:
    """(chave, nm_cc) of the map; several cost centres may share one key."""
    key = collation_key(F.col("ano").cast("string"), "projeto", "acao", "unidade")
    return cc_map.select(key.alias("chave"), F.col("cc").alias("nm_cc"))


def budget_with_cc(budget: DataFrame, cc_map: DataFrame) -> DataFrame:
    """Budget rows with ``nm_cc``, one row per matching cost centre.

    Year, initiative, action and unit match without case, accents and trailing
    blanks. Cancelled and unnamed initiatives are left out.

    The sort key of a collated text is made under a lock that all tasks of a process share.
    So each spelling is matched once, however many rows have it, and the rows meet the
    matches by plain text.
    """
    alive = budget.filter(~F.col("nm_iniciativa").ilike(CANCELLED_INITIATIVE))
    written = F.concat_ws("", F.col("vl_ano").cast("string"), "nm_iniciativa", "nm_acao", "nm_unidade")
    spelled = alive.withColumn("_grafia", written)
    spellings = spelled.select("_grafia").distinct().withColumn("chave", collation_key("_grafia"))
    matched = lookup_join(spellings, name_keys(cc_map), "chave", "inner").select("_grafia", "nm_cc")
    return lookup_join(spelled, matched, "_grafia").drop("_grafia")


def plan_filter(
    budget: DataFrame, plans: list[str], last_month: int | None = None
) -> DataFrame:
    """Budget rows of the given plans, up to a month of the year."""
    kept = budget.filter(F.col("nm_ppa").isin(plans))
    return kept if last_month is None else kept.filter(F.col("vl_mes") <= last_month)
