"""Run registered queries next to their SQL counterpart and compare every value.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(rows, order):
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: [(v is not None, str(type(v)), str(v)) for v in r])


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark result and a SQL result, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    }
    for name, kind in df.dtypes:
        if expected.get(kind) != kinds[name]:
            return f"type of {name}: {kind} against {kinds[name]}"
    order = sorted(df.columns)
    mine = _sorted_rows(df.collect(), [df.columns.index(c) for c in order])
    theirs = _sorted_rows(theirs, [names.index(c) for c in order])
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(c, x, y) for c, x, y in zip(order, a, b) if x != y]
        return f"{len(wrong)} of {len(mine)} rows differ, first in {str(cells)[:400]}"
    return None


def main() -> int:
    import __spark_entry__ as registry
    from tests.conftest import build

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = build()
    con = connect(sf_dir)
    queries, sqls = registry.queries(), registry.oracle_sql()
    failed = 0
    for name in chosen or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sqls:
                problem = difference(df, con, sqls[name])
            else:
                problem = f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - the listing goes on
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failed += problem is not None
        print(f"{name:34s} {time.time() - start:6.2f}s  {problem or 'equal'}", flush=True)
    missing = sorted(set(sqls) - set(queries))
    print(f"{len(queries)} queries, {len(sqls)} with SQL, {failed} not equal, unknown: {missing}")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
