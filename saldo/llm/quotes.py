"""Quotation linking: conversations in reply order from messages that quote each other.

A message's lines are split into own text (level 0) and quoted passages (the number
of ``>`` before them). Passages are normalised and hashed, and joined to the
messages that hold the same passage as own text: whole texts, and single lines of
``MIN_LINE`` characters or more for trimmed quotes. The earliest holder in the
same thread is the original, else the earliest one anywhere. The shallowest quote
that finds an original names the parent.

Originals are reduced to one row for each passage before they are joined, so a
text that a third of all messages share is one row there and only the quoting
side is hot, which AQE splits. Roots and depths come from pointer jumping over
narrow rows: the number of rounds is the logarithm of the deepest thread.

A message is known by (thread, place); places order a thread. Parents always
precede, by place and then thread, so there are no cycles.

Defined results: a null text counts as empty; empty passages link nothing; of
repeated rows with the same (thread, place) all get the same parent, taken from
the best quote of any of them; rows with null thread or place stay as their own
roots; lines that announce a quote ("... wrote:") are dropped before one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.session import ensure_checkpoint_dir

MIN_LINE = 40
#: A passage is known by two hashes of its normalised text and the text's length.
PASSAGE = ["h", "m", "n"]
# Ends of lines that announce a quotation.
ANNOUNCES = r"(?i)(wrote|schrieb|écrit|a écrit|escribió|ha scritto|escreveu)\s?:\s*$"
MARKS = r"^\s{0,3}((?:>\s?)+)"


def parse(text: Column) -> Column:
    """Lines of a message as array<struct<level:int, content:string>>, announcements before quotes dropped."""
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\r?\n"),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", "")).alias("level"),
            F.regexp_replace(x, MARKS, "").alias("content"),
        ),
    )
    return F.filter(
        lines,
        lambda x, i: ~(
            (x["level"] == 0)
            & x["content"].rlike(ANNOUNCES)
            & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)
        ),
    )


def normalise(text: Column) -> Column:
    """Lower case, single blanks, none at the ends."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _passages(lines: Column) -> Column:
    """Runs of quoted lines of one level as array<struct<level, content>>."""
    n = F.size(lines)
    level = lambda i: F.coalesce(F.get(lines, i)["level"], F.lit(-1))
    begins = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (level(i) > 0) & (level(i) != level(i - 1)))
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: (level(i - 1) > 0) & (level(i) != level(i - 1)))
    return F.transform(
        F.arrays_zip(begins.alias("a"), ends.alias("b")),
        lambda x: F.struct(
            level(x["a"]).alias("level"),
            F.transform(F.slice(lines, x["a"] + 1, x["b"] - x["a"]), lambda y: y["content"]).alias("content"),
        ),
    )


def _units(content: Column, level: Column) -> Column:
    """Hashable parts of a passage: the whole (part 0) and its long lines (part 1)."""
    whole = F.struct(level.alias("level"), F.lit(0).alias("part"), normalise(F.array_join(content, "\n")).alias("t"))
    single = F.transform(
        content, lambda x: F.struct(level.alias("level"), F.lit(1).alias("part"), normalise(x).alias("t"))
    )
    chosen = F.filter(single, lambda x: F.length(x["t"]) >= MIN_LINE)
    return F.filter(F.concat(F.array(whole), chosen), lambda x: x["t"] != "")


def link(messages: DataFrame, thread: str, place: str, text: str) -> DataFrame:
    """(thread, place, parent_thread, parent_place): one row for each message known by thread and place."""
    ensure_checkpoint_dir(messages.sparkSession)
    parsed = messages.filter(F.col(thread).isNotNull() & F.col(place).isNotNull()).select(
        F.col(thread).alias("thread"), F.col(place).alias("place"), parse(F.col(text)).alias("lines")
    )
    own = F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["content"])
    quoted = F.flatten(F.transform(_passages(F.col("lines")), lambda x: _units(x["content"], x["level"])))
    units = parsed.select("thread", "place", F.explode(F.concat(_units(own, F.lit(0)), quoted)).alias("u")).select(
        "thread", "place", "u.level", "u.part", F.xxhash64("u.t").alias("h"), F.hash("u.t").alias("m"), F.length("u.t").alias("n")
    )
    # narrow, and read three times: messages are parsed once for them
    units = units.checkpoint()
    held = units.filter("level = 0").groupBy("thread", *PASSAGE).agg(F.min("place").alias("at"))
    anywhere = held.groupBy(*PASSAGE).agg(F.min(F.struct("at", "thread")).alias("first")).select(
        *PASSAGE, F.col("first.at").alias("any_at"), F.col("first.thread").alias("any_thread")
    )
    asked = units.filter("level > 0").distinct()
    near = asked.join(held, ["thread", *PASSAGE], "left").withColumn("at", F.when(F.col("at") < F.col("place"), F.col("at")))
    inside = near.filter(F.col("at").isNotNull()).select(
        "thread", "place", F.struct("level", F.lit(0).alias("far"), "part", "at", F.col("thread").alias("by")).alias("best")
    )
    outside = (
        near.filter(F.col("at").isNull())
        .join(anywhere, PASSAGE)
        .filter(F.struct("any_at", "any_thread") < F.struct("place", "thread"))
        .select(
            "thread", "place",
            F.struct("level", F.lit(1).alias("far"), "part", F.col("any_at").alias("at"), F.col("any_thread").alias("by")).alias("best"),
        )
    )
    found = inside.unionByName(outside).groupBy("thread", "place").agg(F.min("best").alias("best"))
    return found.select(
        "thread", "place", F.col("best.by").alias("parent_thread"), F.col("best.at").alias("parent_place")
    )


def roots(links: DataFrame) -> DataFrame:
    """(thread, place, root_thread, root_place, depth) for messages with a parent, by pointer jumping.

    Messages that have reached their root leave; a round joins only the others.
    """
    ensure_checkpoint_dir(links.sparkSession)
    known = ["thread", "place", "up_thread", "up_place", "depth"]
    going = links.select(
        "thread", "place", F.col("parent_thread").alias("up_thread"), F.col("parent_place").alias("up_place"), F.lit(1).alias("depth")
    ).checkpoint()
    done = None
    while True:
        every = going if done is None else going.unionByName(done)
        above = every.select(
            F.col("thread").alias("up_thread"), F.col("place").alias("up_place"),
            F.col("up_thread").alias("next_thread"), F.col("up_place").alias("next_place"), F.col("depth").alias("more"),
        )
        jumped = going.join(above, ["up_thread", "up_place"], "left").select(
            "thread", "place",
            F.coalesce("next_thread", "up_thread").alias("up_thread"),
            F.coalesce("next_place", "up_place").alias("up_place"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("more").isNotNull().alias("moved"),
        ).checkpoint()
        ended = jumped.filter(~F.col("moved")).select(*known)
        done = ended if done is None else done.unionByName(ended)
        going = jumped.filter("moved").select(*known)
        if going.isEmpty():
            return done.select(
                "thread", "place", F.col("up_thread").alias("root_thread"), F.col("up_place").alias("root_place"), "depth"
            )


def conversations(messages: DataFrame, thread: str, place: str, text: str) -> DataFrame:
    """All messages as (row, own_text, parent_thread, parent_place, root_thread, root_place, depth).

    A conversation is all messages of one root; (depth, place) is the reply order.
    ``row`` is a struct of the input columns, so their names cannot clash.
    """
    ensure_checkpoint_dir(messages.sparkSession)
    links = link(messages, thread, place, text).checkpoint()
    known = links.join(roots(links), ["thread", "place"])
    rows = messages.select(F.struct(*messages.columns).alias("row"))
    own = F.array_join(F.transform(F.filter(parse(F.col(f"row.{text}")), lambda x: x["level"] == 0), lambda x: x["content"]), "\n")
    same = (F.col(f"row.{thread}") == known["thread"]) & (F.col(f"row.{place}") == known["place"])
    joined = rows.join(known, same, "left")
    return joined.select(
        "row",
        F.trim(F.regexp_replace(own, r"^\n+|\n+$", "")).alias("own_text"),
        "parent_thread", "parent_place",
        F.when(F.col("depth").isNull(), F.col(f"row.{thread}")).otherwise(F.col("root_thread")).alias("root_thread"),
        F.when(F.col("depth").isNull(), F.col(f"row.{place}")).otherwise(F.col("root_place")).alias("root_place"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
    )


def as_replies(turns: DataFrame, thread: str = "conv_id", place: str = "turn", text: str = "text") -> DataFrame:
    """Turns written as mail replies: each quotes the turn before it and, a level deeper, the one before that."""
    earlier = turns.groupBy(F.col(thread).alias("t"), F.col(place).alias("p")).agg(F.min(text).alias("said"))
    one = earlier.select("t", (F.col("p") + 1).alias("p1"), F.col("said").alias("said1")).withColumnRenamed("t", "t1")
    two = earlier.select("t", (F.col("p") + 2).alias("p2"), F.col("said").alias("said2")).withColumnRenamed("t", "t2")
    mark = lambda c, m: F.concat(F.lit(m), F.regexp_replace(F.col(c), "\n", f"\n{m}"))
    body = F.concat_ws("\n", F.when(F.col("said1").isNotNull(), F.lit("They wrote:")), mark("said2", ">> "), mark("said1", "> "), F.col(text))
    return (
        turns.join(one, (F.col(thread) == F.col("t1")) & (F.col(place) == F.col("p1")), "left")
        .join(two, (F.col(thread) == F.col("t2")) & (F.col(place) == F.col("p2")), "left")
        .withColumn(text, body)
        .select(*turns.columns)
    )
