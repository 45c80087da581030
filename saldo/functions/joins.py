"""Joins whose strategy depends on how large or how skewed a side is."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from saldo.session import ensure_checkpoint_dir

BROADCAST_BYTES = 16 * 1024 * 1024
BROADCAST_ROWS = 200_000
ROWS_PER_TASK = 2_000_000
#: Joined rows that one key may give in one task where both sides are counted.
PAIRS_PER_TASK = 100_000_000
#: A copy of a left row is only made for a slot of at least so many right rows.
ROWS_PER_COPY = 100
#: Ranges of key hashes in which rows are counted before any key is.
HASH_RANGES = 16_384
#: Bytes in memory for a byte of a plan's estimate, which for a scan is the size of compressed files.
EXPANSION = 8


def _planned_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, or None where the session has none."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _surely_small(df: DataFrame, max_bytes: int) -> bool:
    """Whether the plan's estimate alone proves that a table is within the limit."""
    planned = _planned_bytes(df)
    return planned is not None and planned * EXPANSION <= max_bytes


def small_copy(
    df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS
) -> DataFrame | None:
    """A table proven small enough to ship to every executor, else None.

    A plan estimate that is within the limit when unpacked ``EXPANSION`` times is proof
    enough. An estimate may be far too high, or the size of files that unpack to much
    more, so any other table is computed up to one row over the row limit, kept as a
    checkpoint and measured: if it ends before the limit and its rows as text are within
    the byte limit, the copy is the whole table and the join reads it instead of
    computing it again.
    """
    if _surely_small(df, max_bytes):
        return df
    ensure_checkpoint_dir(df.sparkSession)
    start = df.limit(max_rows + 1).checkpoint()
    size = F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")
    held = start.agg(F.count(F.lit(1)).alias("rows"), size).first()
    return start if held["rows"] <= max_rows and (held["bytes"] or 0) <= max_bytes else None


def lookup_join(
    left: DataFrame, right: DataFrame, on: Column | list[Column] | str | list[str], how: str = "left"
) -> DataFrame:
    """Join a fact to a reference table.

    A reference table of proven size is broadcast, so the fact is not shuffled
    and a hot key costs nothing. A larger one falls back to a shuffle join,
    where AQE splits hot partitions of the fact side.
    """
    small = small_copy(right)
    return left.join(right if small is None else F.broadcast(small), on, how)


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """All keys with more rows than a task should hold, each with the number of slots to use.

    Every key is counted and the limit does not grow with the table, so there are
    at most (rows / limit) such keys. Nothing runs until the join does.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > rows_per_task)
        .select(*keys, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_slots"))
    )


def _same(one: DataFrame, two: DataFrame, ours: list[str], theirs: list[str], null_safe: bool) -> Column:
    """Whether the columns of two tables are equal, pair by pair."""
    pairs = [(one[a], two[b]) for a, b in zip(ours, theirs)]
    return reduce(lambda x, y: x & y, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def counted_keys(
    left: DataFrame, right: DataFrame, keys: dict[str, str], null_safe: bool, rows_per_task: int, pairs_per_task: int
) -> DataFrame:
    """All keys of both sides with their rows there, their joined rows and the slots to use.

    A key's joined rows are the product of its rows on both sides, so a key may be far too
    much for a task while each side of it is small.
    """
    theirs, names = list(keys.values()), [f"_de_{k}" for k in keys]
    ours = left.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("_others"))
    counted = right.groupBy(*theirs).agg(F.count(F.lit(1)).alias("_rows"))
    met = counted.join(ours, _same(counted, ours, theirs, names, null_safe), "full").fillna(0, ["_rows", "_others"])
    pairs = F.col("_rows").cast("double") * F.col("_others")
    by_pairs = F.least(F.ceil(pairs / pairs_per_task), F.ceil(F.col("_rows") / ROWS_PER_COPY))
    slots = F.greatest(F.lit(1), F.ceil(F.col("_rows") / rows_per_task), by_pairs)
    return met.select(*theirs, "_rows", "_others", pairs.alias("_pairs"), slots.cast("int").alias("_slots"))


def full_ranges(df: DataFrame, keys: list[str], rows: int) -> Column | None:
    """Condition for the ranges of key hashes with more than ``rows`` rows; None if there are none.

    Rows are counted in each task first, so that no more than ``HASH_RANGES`` counts a task
    are shuffled, however many keys there are. A key of more rows is in such a range. Texts that
    are equal by a collation have hashes of their own, so such keys are all one range.
    """
    folded = [f for f in df.schema.fields if f.name in keys and isinstance(f.dataType, StringType)]
    if any(not f.dataType.isUTF8BinaryCollation() for f in folded):
        return F.lit(True)
    part = F.pmod(F.xxhash64(*keys), F.lit(HASH_RANGES))
    full = df.groupBy(part.alias("_faixa")).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > rows)
    found = [r["_faixa"] for r in full.select("_faixa").collect()]
    return part.isin(found) if found else None


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of hot keys with ``_right_slot`` in place of ``_slots``, the number of slots of their key.

    Equal rows are counted first, which combines them in each task, and then take the slots
    in turn from the one that the row's hash names. So the slots depend on the rows alone and
    not on their order, and a key whose rows are all equal is divided too.
    """
    columns = [c for c in rows.columns if c != "_slots"]
    counted = rows.groupBy(*[f"`{c}`" for c in columns], "_slots").agg(F.count(F.lit(1)).alias("_times"))
    copies = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))))
    turn = F.pmod(F.xxhash64(*[f"`{c}`" for c in columns]), F.col("_slots")) + F.col("_copy")
    slot = F.pmod(turn, F.col("_slots")).cast("int")
    return copies.withColumn("_right_slot", slot).drop("_slots", "_times", "_copy")


def skewed_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: dict[str, str],
    null_safe: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    max_bytes: int = BROADCAST_BYTES,
    unique: bool = False,
    *,
    pairs_per_task: int | None = None,
) -> DataFrame:
    """Left join for two large tables whose hot keys may sit on either side.

    A right side surely under the broadcast limit is broadcast; keys do not matter then.
    Hot keys of the left side are split by AQE. It cannot split the right side of
    a left join, so the rows of a key that is hot there are dealt into slots and
    the left rows of that key are copied once per slot. Copies that meet no row are
    taken out again: every such key has rows, so one copy at least stays. With a
    ``unique`` right key no key can be hot there and a plain left join is enough.

    Whether there are hot keys is counted while the plan is built, by ranges of key hashes and
    exactly within the full ones. Without any, each side is shuffled once, for a plain join.
    The hot keys are at most (rows / limit), so they are broadcast and no side is shuffled to
    meet them.

    A join whose result is far larger than its sides gives ``pairs_per_task``: keys are then
    counted on both sides, and those with more joined rows are dealt too. AQE sizes tasks by
    what they read, not by what they make, so where no left key is left to it to be split
    the number of tasks follows from the joined rows (not with ``null_safe``).

    Slots follow from the rows themselves (see ``dealt``), so a repeated task after a lost
    executor gives every row the slot it had before. The right side is read a second time
    for the counts, and once more for the rows of its hot keys.

    ``keys`` maps left columns to right columns; the right columns must have
    names of their own, and all of them stay in the result.
    """
    ours, theirs = list(keys), list(keys.values())
    plain = _same(left, right, ours, theirs, null_safe)
    if _surely_small(right, max_bytes):
        return left.join(F.broadcast(right), plain, "left")
    if unique:
        return left.join(right, plain, "left")

    ensure_checkpoint_dir(left.sparkSession)
    present = right if null_safe else right.dropna(subset=theirs)
    tasks = None
    if pairs_per_task is None:
        full = full_ranges(present, theirs, rows_per_task)
        if full is None:
            return left.join(right, plain, "left")
        found = hot_keys(present.filter(full), theirs, rows_per_task)
    else:
        counts = counted_keys(left, present, keys, null_safe, rows_per_task, pairs_per_task).checkpoint()
        share = F.max(F.greatest(F.col("_pairs") / F.col("_slots") / pairs_per_task, F.col("_others") / rows_per_task))
        made = counts.agg(F.sum("_pairs").alias("pairs"), share.alias("share")).first()
        if not null_safe and (made["share"] or 0) <= 1:
            least = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            tasks = max(least, math.ceil((made["pairs"] or 0) / pairs_per_task))
        found = counts.filter(F.col("_slots") > 1).select(*theirs, "_slots")

    def spread(side: DataFrame, columns: list[str]) -> DataFrame:
        return side if tasks is None else side.repartition(tasks, *columns)

    names = [f"_hot_{k}" for k in theirs]
    kept = found.withColumnsRenamed(dict(zip(theirs, names))).checkpoint()
    if kept.isEmpty():
        one, two = spread(left, ours), spread(right, theirs)
        return one.join(two, _same(one, two, ours, theirs, null_safe), "left")
    hot = F.broadcast(kept)

    slotted = left.join(hot, _same(left, hot, ours, names, null_safe), "left").drop(*names)
    copies = slotted.withColumn("_slots", F.coalesce("_slots", F.lit(1))).withColumn(
        "_slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1))
    )
    known = _same(right, hot, theirs, names, null_safe)
    cold = right.join(hot, known, "left_anti").withColumn("_right_slot", F.lit(0))
    pieces = cold.union(dealt(right.join(hot, known).drop(*names))).withColumn("_met", F.lit(True))
    copies, pieces = spread(copies, [*ours, "_slot"]), spread(pieces, [*theirs, "_right_slot"])
    on = _same(copies, pieces, ours, theirs, null_safe) & (copies["_slot"] == pieces["_right_slot"])
    joined = copies.join(pieces, on, "left").filter((F.col("_slots") == 1) | F.col("_met"))
    return joined.drop("_slot", "_slots", "_right_slot", "_met")


def spread_nulls(key: Column, *row: str) -> Column:
    """Text join key in which NULL never matches and never forms a hot key.

    All NULL keys of an outer join would meet in one task. They get values
    outside the key space instead, spread by the row's own content.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.xxhash64(*row).cast("string")))
