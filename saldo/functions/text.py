"""Text rules: collation keys, local-format numbers, identifiers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Compares without case, accents and trailing blanks, for letters of every script.
NAME_COLLATION = "UNICODE_CI_AI_RTRIM"

# A cast to double would accept the type suffixes of Java literals (1.5d, 2f).
JAVA_SUFFIX = r"[0-9.][dDfF]\s*$"


def collation_key(*parts: Column | str) -> Column:
    """Concatenation compared without case, accents or trailing blanks.

    NULL parts count as empty text. The value keeps its spelling; only comparisons
    follow the collation. Spark joins and groups such columns by their sort keys, so an
    equality of them is an ordinary hash or sort-merge join.
    """
    return F.collate(F.concat_ws("", *parts), NAME_COLLATION)


def spelled(value: Column | str) -> Column:
    """A collated value as plain text, compared byte by byte."""
    return F.collate(value, "UTF8_BINARY")


def fold_case(value: Column | str) -> Column:
    """Case-insensitive comparison form that also ignores trailing blanks."""
    return F.rtrim(F.upper(value))


def folded_in(value: Column | str, choices: list[str]) -> Column:
    """Membership test under a case-insensitive collation."""
    return fold_case(value).isin([choice.upper().rstrip() for choice in choices])


def plain_number(value: Column | str) -> Column:
    """Text to double; anything unreadable, and NULL, is 0."""
    column = F.col(value) if isinstance(value, str) else value
    text = column.cast("string")
    number = F.when(~text.rlike(JAVA_SUFFIX), text.try_cast("double"))
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(0.0))


def local_number(value: Column | str) -> Column:
    """``1.234,56`` to 1234.56; anything unreadable, and NULL, is 0."""
    column = F.col(value) if isinstance(value, str) else value
    digits = F.replace(F.replace(column, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain_number(digits)


def id_text(value: Column | str) -> Column:
    """Whole-number id as text; NULL becomes the literal ``<NA>``, one shared id."""
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("string"), F.lit("<NA>"))
