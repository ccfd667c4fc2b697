"""Compare registered queries with their check SQL. Usage: oracle_check.py DIR [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{directory}/{table}.parquet'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, query, sql: str, directory: str) -> str:
    """Empty if rows, names and type families agree, else what differs."""
    df = query(spark, directory)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if different:
        return f"{len(different)} of {len(mine)} rows differ, e.g. {different[0]}"
    return "" if mine else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as contract
    from tallgrove.session import local_session

    directory, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    connection = connect(directory)
    checks = contract.oracle_sql()
    bad = 0
    for name, function in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in checks:
                problem = compare(spark, connection, function, checks[name], directory)
            else:
                problem = "" if function(spark, directory).collect() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "O" if name in checks else "R"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - start:.2f}s {problem}", flush=True)
    print("unknown checks:", sorted(set(checks) - set(contract.queries())), "failed:", bad)
