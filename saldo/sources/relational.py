"""Relational scans and reference lists."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    fetch_size: int = 20_000,
    predicates: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """A table or ``(select ...) alias`` over JDBC, read in parallel slices.

    Filters and column choices made on the result are pushed to the server.
    Without a partition column the whole read is one task, so give one for
    anything large: equal widths between two bounds, or ``predicates`` (from
    ``balanced_predicates``) where the key is unevenly spread. A script without a
    result, that is no table at all, is an empty table and a warning.
    """
    if not table or not table.strip():
        log.warning("the script has no SELECT; its result is empty")
        return spark.createDataFrame([], T.StructType([]))
    if predicates is not None:
        properties = {"fetchsize": str(fetch_size), **options}
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    settings = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **options}
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs its lower and upper bound")
        low, high = bounds
        settings |= {
            "partitionColumn": partition_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**settings).load()


def _literal(value: object) -> str:
    """A key as SQL text."""
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no slices by a key of {type(value).__name__}")


def key_quantiles(sample: DataFrame, key: str, slices: int) -> list[object]:
    """Rising values of the key that divide the sample's rows into ``slices`` parts of about equal size.

    A sample is what its name says: some thousand rows of the key, read over JDBC with the
    server's own sampling, or the keys of an earlier load. Fewer values come back where
    single ones hold more than a part.
    """
    counted = sample.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    rows = sorted(((r[0], r[1]) for r in counted.collect()), key=lambda r: r[0])
    left = sum(n for _, n in rows)
    want, cuts, held = left / slices, [], 0  # held: rows since the last cut
    for value, n in rows:
        # a cut goes before the value if the part is nearer to its size without it
        if held and (held + n - want > want - held or held >= want) and len(cuts) < slices - 1:
            cuts.append(value)
            left, held = left - held, 0
            want = left / (slices - len(cuts))  # else what the parts miss adds up in the last one
        held += n
    return cuts


def balanced_predicates(sample: DataFrame, key: str, slices: int) -> list[str]:
    """Conditions that divide a table into parts of about equal size, each row in exactly one.

    Unlike equal widths between the smallest and the largest key, they follow where the
    keys are. Rows without key go with the first part. One value is never divided, so a
    value with more rows than a part makes a part of its own.
    """
    if slices < 1:
        raise ValueError("one slice at least")
    cuts = [_literal(v) for v in key_quantiles(sample, key, slices)]
    if not cuts:
        return ["1 = 1"]
    parts = [f"({key} < {cuts[0]} OR {key} IS NULL)"]
    parts += [f"({key} >= {a} AND {key} < {b})" for a, b in zip(cuts, cuts[1:])]
    return [*parts, f"({key} >= {cuts[-1]})"]


def scan_project(
    spark: SparkSession, path: str, columns: list[str] | None = None, file_format: str = "parquet"
) -> DataFrame:
    """A stored source table, all columns or some of them."""
    table = spark.read.format(file_format).load(path)
    return table.select(*columns) if columns else table


def read_list(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A reference list kept as CSV with a header.

    The account allow-list is read with ``conta string`` and the cost-centre
    years with ``cc string, ano string``; codes stay text, so leading zeros
    survive.
    """
    return spark.read.csv(path, header=True, schema=schema)
