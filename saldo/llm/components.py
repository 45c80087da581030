"""Connected components of links between documents, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.session import work_path


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table of the shared folder.

    Like a checkpoint it has no lineage. But its size is that of its files: a checkpoint keeps
    the plan's estimate, and estimates of joins are products, whose digits double in every
    round of a loop until they fill the driver.
    """
    place = work_path(df.sparkSession, "links")
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component, for all nodes of the edges (a, b).

    Every round takes the smallest label among neighbours and then the label's own
    label, so labels travel over ever longer ways. Minima are combined before the
    shuffle; a hub is hot only on the side of a join that AQE splits.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter(F.col("a") != F.col("b")).distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    labels = stored(labels.select("node", F.least("node", "low").alias("label")))
    while True:
        theirs = labels.select(F.col("node").alias("b"), F.col("label").alias("their_label"))
        near = both.join(theirs, "b").groupBy(F.col("a").alias("node")).agg(F.min("their_label").alias("low"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "low").alias("lower"))
        lower = stored(lower)
        ends = lower.select(F.col("node").alias("lower"), F.col("lower").alias("end"))
        jumped = stored(lower.join(ends, "lower").select(
            "node", F.least("lower", "end").alias("label"), (F.least("lower", "end") != F.col("label")).alias("moved")
        ))
        labels = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return labels
