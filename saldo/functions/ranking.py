"""Positions over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.session import ensure_checkpoint_dir


def number_rows(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Add the 1-based position of each row in the given total order.

    Rows are range-partitioned and sorted, then pinned with a checkpoint so
    that the partition boundaries hold for both passes: one counts rows per
    partition, the other adds that offset to the place within the partition.
    The running total covers one row per partition only.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumn("_part", F.shiftright("_slot", 33)).withColumn(
        "_place", F.col("_slot") - F.shiftleft("_part", 33)
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_base") + F.col("_place") + 1).cast("bigint"))
        .drop("_part", "_place", "_slot", "_base")
    )


def first_rows(df: DataFrame, n: int, by: list[str], *order: Column) -> DataFrame:
    """The first ``n`` rows per group with their ``posicao``.

    Filtering on the row number lets Spark cut each task's rows to ``n`` per
    group before the shuffle, so a hot group never travels whole.
    """
    position = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("posicao", position).filter(F.col("posicao") <= n)
