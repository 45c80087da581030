"""Line dedup by site-relative frequency.

For each host the pages that contain a line are divided by all pages of the host;
lines above the boilerplate ratio are taken out of that host's pages. Everything
runs on 64-bit line hashes: a page contributes each of its lines once, counts are
combined before the shuffle, and only lines on ``MIN_PAGES`` pages or more meet
the host totals. A host has at most (lines a page / ratio) such lines, so they fit
an array; where all arrays together are small they are broadcast and no text is
shuffled, otherwise the pages are joined by host and AQE splits hot hosts.

Defined results: lines are compared without blanks at their ends; blank lines stay;
a null text stays null; pages without host are not changed; a repeated row counts
as a page of its own; a page may lose all its lines and then has an empty text.
A line of fewer than ``MIN_PAGES`` pages stays, so small hosts lose nothing by chance.

With ``spare_copies`` (the pipeline) copies are told apart from boilerplate. Pages of
one host with equal lines count as one page, so exact copies stay whole for the
near-dedup after it. Near copies still share most of their lines: of the pages that
would lose ``MOSTLY`` of their text or more, one for each set of lost lines stays
whole, so no text is lost in all its copies. These pages meet by hashes; texts are
shuffled only if there are too many of them to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.session import ensure_checkpoint_dir

RATIO, MIN_PAGES, BROADCAST_BYTES, MOSTLY = 0.1, 5, 32 * 1024 * 1024, 0.5


def line_hashes(text: str) -> Column:
    """Hashes of the lines of a text column; null for blank lines."""
    return F.transform(F.split(F.col(text), "\n"), lambda x: F.when(F.trim(x) != "", F.xxhash64(F.trim(x))))


def boilerplate(
    docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
    spare_copies: bool = False,
) -> DataFrame:
    """(site, lines): for each host the hashes of the lines above the ratio."""
    pages = docs.select(F.col(host).alias("site"), F.col(text).alias("body")).filter(F.col("site").isNotNull())
    if spare_copies:
        pages = pages.withColumn("page", F.xxhash64(line_hashes("body")))
        each = pages.select("site", "page").distinct()
        lines = pages.select("site", "page", F.explode(line_hashes("body")).alias("line")).distinct()
    else:
        each, lines = pages, pages.select("site", F.explode(F.array_distinct(line_hashes("body"))).alias("line"))
    totals = each.groupBy(F.col("site").alias("total_site")).agg(F.count(F.lit(1)).alias("pages"))
    counted = (
        lines.filter(F.col("line").isNotNull())
        .groupBy("site", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_pages)
    )
    frequent = counted.join(totals, counted["site"] == totals["total_site"]).filter(F.col("n") > F.col("pages") * ratio)
    return frequent.groupBy("site").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def remove_boilerplate(
    docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
    spare_copies: bool = False,
) -> DataFrame:
    """All rows and columns of ``docs`` with the remaining text, as (row, text_kept, lines_dropped).

    ``row`` is a struct of the input columns, so their names cannot clash.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    sites = boilerplate(docs, text, host, ratio, min_pages, spare_copies).checkpoint()
    held = sites.agg(F.sum(F.size("lines") * 8 + F.octet_length("site") + 64).alias("b")).first()["b"] or 0
    known = F.broadcast(sites) if held <= BROADCAST_BYTES else sites
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    joined = rows.join(known, F.col(f"row.{host}") == F.col("site"), "left")
    parts = F.split(F.col(f"row.{text}"), "\n")
    stays = lambda x: (F.trim(x) == "") | ~F.array_contains("lines", F.xxhash64(F.trim(x)))
    kept = F.when(F.col("lines").isNull(), parts).otherwise(F.filter(parts, stays))
    if spare_copies:
        lost = F.array_sort(F.array_intersect(F.filter(line_hashes(f"row.{text}"), lambda x: x.isNotNull()), "lines"))
        length = lambda lines: F.length(F.array_join(lines, ""))
        shared = F.when(length(kept) <= length(parts) * (1 - MOSTLY), F.xxhash64(lost))
        pages = joined.select("row", "site", "lines", F.xxhash64(line_hashes(f"row.{text}")).alias("page"), shared.alias("shared"))
        whole = pages.filter("lines is not null and shared is not null").groupBy("site", "shared").agg(F.min("page").alias("page"))
        whole = whole.select(*[F.col(c).alias(f"whole_{c}") for c in ("site", "shared", "page")]).checkpoint()
        held = whole.agg(F.sum(F.octet_length("whole_site") + 64).alias("b")).first()["b"] or 0
        on = [F.col(c) == F.col(f"whole_{c}") for c in ("site", "shared", "page")]
        joined = pages.join(F.broadcast(whole) if held <= BROADCAST_BYTES else whole, on, "left")
        kept = F.when(F.col("whole_page").isNotNull(), parts).otherwise(kept)
    return joined.select("row", kept.alias("kept"), F.size(parts).alias("n")).select(
        "row",
        F.array_join("kept", "\n").alias("text_kept"),
        F.when(F.col("kept").isNull(), 0).otherwise(F.col("n") - F.size("kept")).alias("lines_dropped"),
    )
