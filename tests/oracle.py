"""Compare each registered query with its SQL twin in DuckDB.

Run as a script: ``python tests/oracle.py [sf] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    data = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(data, key=repr)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = _rows(names, cur.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]}"
    kinds = [(a, b) for x, y in zip(ours[1][:1], theirs[1][:1]) for a, b in zip(x, y)
             if a is not None and b is not None and type(a) is not type(b)]
    return f"types differ: {kinds}" if kinds else None


def main() -> None:
    from fabspark.session import get_spark

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = get_spark("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                      spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(folder), entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                problem = compare(df, con, sqls[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s"
              + ("" if name in sqls else " (rows only)") + (f" {problem}" if problem else ""), flush=True)
        if problem:
            failed.append(name)
    print(f"failed: {failed}")


if __name__ == "__main__":
    main()
