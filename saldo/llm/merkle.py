"""Merkle manifest of a dataset by checkpoint-and-recompute.

Every row is a leaf: the SHA-256 of its fields. Each group's leaves, ordered by
key, form a tree of fan-out ``FANOUT``; the groups' roots, ordered by group, form a
tree above them whose root stands for the whole dataset.

Only every ``EVERY``-th level is stored. A stored row is an aligned subtree: the up to
``FANOUT ** EVERY`` digests of one stored level below one node of the next. Proofs go
from the top down; at each stored level the levels that were left out are regenerated
inside the row, give the siblings of its nodes, and are discarded. So a path above a
subtree is joined once for the whole subtree, and a row holds a bounded number of digests.

Texts are hashed where they are scanned. Leaves are placed by one range sort of narrow
rows, so a group that holds a third of all rows lies in many tasks; a leaf's place comes
from the counts of (task, group) pairs.

Defined results: a null field is hashed as ``-``; a null group is a group of its own and
comes first; null keys come first; rows with one key are ordered by their digest, and
fully equal rows give equal leaves with proofs of their own places; a group of one leaf
has that leaf as its root; an empty table has no proofs and no root.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saldo.functions.joins import lookup_join
from saldo.functions.ranking import number_rows
from saldo.session import ensure_checkpoint_dir, work_path

FANOUT, EVERY = 16, 2
#: Levels above any number of rows that a long can count.
MOST_LEVELS = 16


def field(column: Column) -> Column:
    """A value as its UTF-8 byte count, ``:`` and the value; ``-`` if null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    """The digest of a row's fields, as lowercase hex."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def tree_depth(n: Column, fanout: int) -> Column:
    """Levels above the leaves until one node remains."""
    return reduce(lambda rest, k: F.when(n <= fanout**k, F.lit(k)).otherwise(rest), range(MOST_LEVELS - 1, -1, -1), F.lit(MOST_LEVELS))


@dataclass(frozen=True)
class Tree:
    """The stored levels of one forest: for each, rows (tree, depth, chunk, nodes, top)."""

    spark: SparkSession
    folder: str
    levels: tuple[int, ...]
    fanout: int
    every: int

    def read(self, level: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/level={level}")

    def roots(self) -> DataFrame:
        """(tree, depth, digest): the topmost node of every tree."""
        tops = [self.read(k).filter(F.col("depth") <= k + self.every) for k in self.levels]
        return reduce(DataFrame.unionByName, [t.select("tree", "depth", F.col("top").alias("digest")) for t in tops])


def _regenerated(nodes: Column, fanout: int) -> Column:
    """The next level of a run of digests."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda r: F.sha2(F.concat_ws("", F.slice(nodes, r * fanout + 1, F.lit(fanout))), 256))


def _interior(chunks: DataFrame, level: int, fanout: int, every: int) -> DataFrame:
    """Adds ``rise``, the levels from the nodes to the chunk's top, and their digests ``_0`` ... ``_every``."""
    found = chunks.withColumn("rise", F.least(F.lit(every), F.col("depth") - level))
    found = found.withColumn("_0", F.col("nodes.digest"))
    for k in range(1, every + 1):
        found = found.withColumn(f"_{k}", F.when(F.col("rise") >= k, _regenerated(F.col(f"_{k - 1}"), fanout)))
    return found


def build(rows: DataFrame, folder: str, fanout: int = FANOUT, every: int = EVERY) -> Tree:
    """Stores the trees of ``rows`` (tree, depth, place, digest, own).

    Each turn stores one level in chunks of ``fanout ** every`` nodes and goes on with one
    node for each chunk, until every tree has its root.
    """
    spark, span = rows.sparkSession, fanout**every
    levels: list[int] = []
    while True:
        level = len(levels) * every
        node = F.struct("place", "digest", "own")
        chunks = rows.groupBy("tree", "depth", F.floor(F.col("place") / span).alias("chunk"))
        chunks = chunks.agg(F.sort_array(F.collect_list(node)).alias("nodes"))
        risen = _interior(chunks, level, fanout, every)
        top = F.coalesce(*[F.element_at(f"_{k}", 1) for k in range(every, -1, -1)])
        place = f"{folder}/level={level}"
        risen.select("tree", "depth", "chunk", "nodes", top.alias("top")).write.parquet(place)
        levels.append(level)
        stored = spark.read.parquet(place).filter(F.col("depth") > level + every)
        if stored.isEmpty():
            return Tree(spark, folder, tuple(levels), fanout, every)
        nothing = F.lit(None).cast("boolean").alias("own")
        rows = stored.select("tree", "depth", F.col("chunk").alias("place"), F.col("top").alias("digest"), nothing)


def no_steps() -> Column:
    """The path of a root."""
    return F.array().cast("array<struct<left:string,right:string>>")


def _siblings(nodes: str, at: Column, fanout: int) -> Column:
    """struct<left, right>: the digests before and after the node in its run, each joined."""
    within = F.pmod(at, F.lit(fanout))
    left = F.slice(nodes, at - within + 1, within)
    right = F.slice(nodes, at + 2, F.lit(fanout - 1) - within)
    return F.struct(F.concat_ws("", left).alias("left"), F.concat_ws("", right).alias("right"))


def paths(tree: Tree, above: DataFrame) -> DataFrame:
    """(tree, place, digest, own, path, *rest) of every leaf of the stored trees.

    ``above`` has for each tree the path from its root upwards, and columns that all its
    leaves get (the rest). A path is an array of struct<left, right> from the leaf up.
    """
    rest = [c for c in above.columns if c not in ("tree", "depth", "path")]
    found = None
    for level in reversed(tree.levels):
        own_top = F.col("depth") <= level + tree.every
        own_top = own_top & (F.col("depth") > level) if level else own_top
        parents = above.filter(own_top).select("tree", F.lit(0).cast("bigint").alias("chunk"), "path", *rest)
        if found is not None:
            parents = parents.unionByName(found.select("tree", F.col("place").alias("chunk"), "path", *rest))
        chunks = _interior(tree.read(level), level, tree.fanout, tree.every).drop("top", f"_{tree.every}")
        children = chunks.join(parents, ["tree", "chunk"]).select("*", F.posexplode("nodes").alias("_at", "_node")).drop("nodes")
        steps = [
            F.when(F.col("rise") > k, F.array(_siblings(f"_{k}", F.floor(F.col("_at") / tree.fanout**k).cast("int"), tree.fanout)))
            for k in range(tree.every)
        ]
        path = F.concat(*[F.coalesce(s, no_steps()) for s in steps], F.col("path"))
        found = children.select("tree", "_node.place", "_node.digest", "_node.own", path.alias("path"), *rest)
    return found


@dataclass(frozen=True)
class Manifest:
    """A dataset's stored trees: ``groups`` over the rows of each group, ``top`` over the groups' roots."""

    groups: Tree
    top: Tree
    root: str | None


def manifest(
    docs: DataFrame, leaf: Column, group: str = "source", key: str = "doc_id",
    carry: dict[str, Column] | None = None, fanout: int = FANOUT, every: int = EVERY,
) -> Manifest:
    """Stores the manifest of ``docs`` in the shared folder.

    ``carry`` names narrow columns that are kept beside a leaf and come back with its proof.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    folder = work_path(spark, "merkle")
    beside = [c.alias(name) for name, c in (carry or {}).items()]
    # a null group sorts before all others and every other keeps its place
    named = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    rows = docs.select(
        named.alias("grp"), F.col(key).alias("key"), leaf.alias("digest"),
        F.struct(F.col(group).alias("group"), F.col(key).alias("key"), F.struct(F.lit(True).alias("kept"), *beside).alias("carried")).alias("own"),
    ).checkpoint()
    # equal rows may be many: the checkpointed row's number divides them between the ranges
    order = [F.asc("grp"), F.asc_nulls_first("key"), F.asc("digest"), F.asc("_row")]
    placed = rows.withColumn("_row", F.monotonically_increasing_id()).orderBy(*order).drop("_row", "key")
    placed = placed.withColumn("_slot", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_slot", 33)
    placed = placed.withColumn("_part", part).withColumn("_in_part", F.col("_slot") - F.shiftleft(part, 33)).drop("_slot")

    pairs = placed.groupBy("_part", "grp").agg(F.count(F.lit(1)).alias("n"), F.min("_in_part").alias("first")).checkpoint()
    before = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begin = (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("begin")
    starts = pairs.select("_part", "grp", begin)
    sizes = number_rows(pairs.groupBy("grp").agg(F.sum("n").alias("n")), "tree", F.asc("grp"))
    sizes = sizes.select("grp", "tree", tree_depth(F.col("n"), fanout).alias("depth")).checkpoint()
    starts = starts.join(sizes, "grp").checkpoint()
    leaves = lookup_join(placed, starts, ["_part", "grp"], "inner")
    leaves = leaves.select("tree", "depth", (F.col("begin") + F.col("_in_part")).alias("place"), "digest", "own")
    groups = build(leaves, f"{folder}/groups", fanout, every)

    above = F.lit(0).cast("bigint")
    deep = tree_depth(F.lit(sizes.count()), fanout)
    subroots = groups.roots().select(
        above.alias("tree"), deep.alias("depth"), (F.col("tree") - 1).alias("place"), "digest",
        F.struct(F.col("tree").alias("of"), F.col("depth").alias("of_depth")).alias("own"),
    )
    top = build(subroots, f"{folder}/top", fanout, every)
    found = top.roots().first()
    return Manifest(groups, top, found["digest"] if found else None)


def proofs(found: Manifest) -> DataFrame:
    """(group, key, leaf, carried, path, subroot, root) of every row of the manifest's dataset."""
    start = found.top.roots().select("tree", "depth", no_steps().alias("path"))
    tops = paths(found.top, start)
    above = tops.select(F.col("own.of").alias("tree"), F.col("own.of_depth").alias("depth"), "path", F.col("digest").alias("subroot"))
    leaves = paths(found.groups, above)
    return leaves.select(
        "own.group", "own.key", F.col("digest").alias("leaf"), "own.carried", "path", "subroot", F.lit(found.root).cast("string").alias("root")
    )


def siblings_text(path: Column) -> Column:
    """All siblings of a path, level by level and left to right, as one text."""
    return F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"])))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))
