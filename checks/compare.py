"""Run registered queries against their SQL and report differences.

``python -m checks.compare [folder] [name ...]``
"""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

from checks.oracles import all_oracles
from checks.registry import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A connection with the test tables as views."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, Decimal):
        return str(value)
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None) is not None:
        return value.replace(tzinfo=None)
    return value


def _rows(table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(table.column_names)
    ordered = table.select(names)
    kinds = [str(t).replace("large_", "").replace(", tz=UTC", "") for t in ordered.schema.types]
    columns = [[_plain(v) for v in c.to_pylist()] for c in ordered.columns]
    rows = sorted(zip(*columns), key=repr) if columns else []
    return names, kinds, rows


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark result and a statement; empty when equal."""
    mine = _rows(result.toArrow())
    theirs = _rows(con.sql(sql).to_arrow_table())
    found = []
    if mine[0] != theirs[0]:
        return [f"columns {mine[0]} against {theirs[0]}"]
    for name, a, b in zip(mine[0], mine[1], theirs[1]):
        if a != b:
            found.append(f"type of {name}: {a} against {b}")
    if len(mine[2]) != len(theirs[2]):
        found.append(f"{len(mine[2])} rows against {len(theirs[2])}")
    elif mine[2] != theirs[2]:
        pairs = [(a, b) for a, b in zip(mine[2], theirs[2]) if a != b]
        found.append(f"{len(pairs)} rows differ, first {pairs[0][0]} against {pairs[0][1]}")
    if not mine[2]:
        found.append("no rows")
    return found


def main() -> None:
    from saldo.session import build_session

    arguments = sys.argv[1:]
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    chosen = arguments[1:] or list(all_queries())
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(folder), 0
    for name in chosen:
        start = time.time()
        try:
            found = differences(all_queries()[name](spark, folder), con, all_oracles()[name])
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.1f}s {'; '.join(found)}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} equal")


if __name__ == "__main__":
    main()
