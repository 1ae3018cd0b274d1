"""Run queries on Spark and their SQL on DuckDB and compare whole results.

As a script: ``python tests/compare.py [folder] [query ...]``.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _kind(t: pa.DataType) -> str:
    return "string" if pa.types.is_string(t) or pa.types.is_large_string(t) else str(t)


def _sorted_rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    data = table.select(names).to_pydict()
    return sorted(zip(*[data[n] for n in names]), key=repr)


def difference(mine: pa.Table, theirs: pa.Table) -> str | None:
    """What differs between two results, None if nothing does; row order does not count."""
    a = {f.name: _kind(f.type) for f in mine.schema}
    b = {f.name: _kind(f.type) for f in theirs.schema}
    if a != b:
        return f"schema {sorted(set(a.items()) ^ set(b.items()))}"
    if mine.num_rows != theirs.num_rows:
        return f"rows {mine.num_rows} != {theirs.num_rows}"
    x, y = _sorted_rows(mine), _sorted_rows(theirs)
    wrong = [(p, q) for p, q in zip(x, y) if repr(p) != repr(q)]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from roomsight.session import session

    args = sys.argv[1:]
    folder = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                              "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args or queries:
        started = time.time()
        try:
            mine = queries[name](spark, folder).toArrow()
            took = time.time() - started
            if name not in oracles:
                verdict = f"rows only: {mine.num_rows}"
            else:
                started = time.time()
                theirs = con.sql(oracles[name]).to_arrow_table()
                other = time.time() - started
                found = difference(mine, theirs)
                verdict = found or f"same {mine.num_rows} rows (SQL {other:.2f}s)"
                bad += found is not None
        except Exception as e:  # report and go on with the next query
            took, bad = time.time() - started, bad + 1
            verdict = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:32s} {took:6.2f}s  {verdict}", flush=True)
    print("failures:", bad)
