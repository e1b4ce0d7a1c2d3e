"""Spark and DuckDB results as comparable rows, and a command line that runs all queries.

    python -m tests.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, (datetime, date)):
        return str(value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
}


def differences(df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = rows_of(names, result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind.upper()) != kinds[name]:
            out.append(f"type of {name}: {kind} against {kinds[name]}")
    if sum(got.values()) != sum(want.values()):
        out.append(f"{sum(got.values())} rows against {sum(want.values())}")
    if got != want:
        out.append(f"columns {sorted(names)}")
        out.append(f"only Spark: {list((got - want).items())[:3]}")
        out.append(f"only SQL: {list((want - got).items())[:3]}")
    return out


def main(sf_dir: str, names: list[str]) -> int:
    from millrace import catalog, oracles
    from millrace.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = oracles.oracle_sql()
    bad = 0
    for name in names or list(catalog.QUERIES):
        start = time.time()
        try:
            df = catalog.QUERIES[name](spark, sf_dir)
            problems = differences(df, con, sqls[name]) if name in sqls else [f"no SQL, {df.count()} rows"]
        except Exception as problem:  # noqa: BLE001
            problems = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        bad += bool(problems)
        print(f"{'DIFF' if problems else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for text in problems:
            print("     ", text, flush=True)
    print(f"{bad} with differences")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
