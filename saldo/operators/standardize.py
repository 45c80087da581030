"""Standard column names and number types for any extracted table."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldo.functions.numbers import MONEY, money, whole_number
from saldo.functions.text import local_number, plain_number
from saldo.operators.mappings import COLUMN_NAMES

WHOLE_COLUMNS = {"vl_ano", "vl_mes"}
NAME_LIMIT = 120
TECHNICAL_PARTS = {"member_caption", "member_key", "caption", "key"}
FUND_COLUMN = "valor_str"


def _snake(text: str) -> str:
    return re.sub(r"\W+", "_", text).strip("_")


def fallback_name(source: str) -> str:
    """Name for a column the dictionary does not know.

    Bracketed cube paths keep their parts without the technical ending and
    without immediate repeats; anything else becomes snake case.
    """
    name = source.lower().strip()
    parts = re.findall(r"\[([^\]]+)\]", name)
    if len(parts) > 1 and parts[-1] in TECHNICAL_PARTS:
        parts = parts[:-1]
    pieces = [_snake(part) for part in parts] or [_snake(name)]
    kept = [piece for i, piece in enumerate(pieces) if i == 0 or piece != pieces[i - 1]]
    joined = "_".join(kept)
    return joined if len(joined) <= NAME_LIMIT else joined[:NAME_LIMIT].strip("_")


def standard_names(columns: list[str], known: dict[str, str] = COLUMN_NAMES) -> dict[str, str]:
    """Source name -> standard name. Two sources for one name are an error."""
    names = {c: known.get(c.lower().strip()) or fallback_name(c) for c in columns}
    repeated = [n for n, times in Counter(v.lower() for v in names.values()).items() if times > 1]
    if repeated:
        raise ValueError(f"several columns would be named {', '.join(sorted(repeated))}")
    return names


def rename_report(columns: list[str], known: dict[str, str] = COLUMN_NAMES) -> dict[str, object]:
    """How many columns the dictionary covers and which it does not."""
    missing = [c.lower().strip() for c in columns if c.lower().strip() not in known]
    return {"total": len(columns), "renamed": len(columns) - len(missing), "unmapped": missing}


def rename_standard(df: DataFrame, known: dict[str, str] = COLUMN_NAMES) -> DataFrame:
    """Rename all columns; only names change, no data is read."""
    names = standard_names(df.columns, known)
    return df.toDF(*[names[c] for c in df.columns])


def is_fund_report(df: DataFrame) -> bool:
    """Whether an extracted table is a fund report, told by its value column."""
    return FUND_COLUMN in {c.lower().strip() for c in df.columns}


def parse_fund_values(df: DataFrame) -> DataFrame:
    """Fund rows: ``vl_valor_str`` in local format becomes ``vl_valor``."""
    return df.withColumn("vl_valor", local_number("vl_valor_str")).drop("vl_valor_str")


def parse_value_column(df: DataFrame, column: str = "vl_valor") -> DataFrame:
    """Text amounts to numbers, NULL to 0, format decided for the whole column.

    One comma anywhere makes the column local format for every row. The test
    is a scalar subquery, so it runs once and reaches the tasks as a constant.
    """
    declared = df.schema[column].dataType
    if isinstance(declared, T.DecimalType):
        return df.withColumn(column, F.coalesce(F.col(column), F.lit(0).cast(declared)))
    if not isinstance(declared, T.StringType):
        return df
    has_comma = df.agg(F.coalesce(F.bool_or(F.contains(column, F.lit(","))), F.lit(False)))
    parsed = F.when(has_comma.scalar(), local_number(column)).otherwise(plain_number(column))
    return df.withColumn(column, parsed)


def is_money(field: T.StructField) -> bool:
    """Decimals, and text or floating ``vl_`` columns; whole numbers stay as they are."""
    if field.name.lower() in WHOLE_COLUMNS:
        return False
    if isinstance(field.dataType, T.DecimalType):
        return True
    loose = isinstance(field.dataType, (T.StringType, T.DoubleType, T.FloatType))
    return field.name.lower().startswith("vl_") and loose


def _scaled(field: T.StructField) -> Column:
    column, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.DecimalType) and kind.scale <= 8 and kind.precision - kind.scale <= 20:
        return column.cast(MONEY)
    return money(column)


def decimal_scale(df: DataFrame) -> DataFrame:
    """Money columns at a fixed scale of 8, decided from the declared types.

    A decimal that fits as it is gets a plain cast; only others are rounded.
    """
    chosen = {f.name: _scaled(f) for f in df.schema.fields if is_money(f)}
    return df.withColumns(chosen) if chosen else df


def int_columns(df: DataFrame) -> DataFrame:
    """Year and month as integers, 0 where unreadable."""
    present = [c for c in df.columns if c.lower() in WHOLE_COLUMNS]
    return df.withColumns({c: whole_number(c) for c in present}) if present else df


def standardize(df: DataFrame) -> DataFrame:
    """Names, amounts and types of one extracted table.

    A table with a ``valor_str`` column is a fund report; all others take the
    common path.
    """
    named = rename_standard(df)
    if is_fund_report(df):
        named = parse_fund_values(named)
    elif "vl_valor" in named.columns:
        named = parse_value_column(named)
    return int_columns(decimal_scale(named))
