"""Compare registered queries with their oracle SQL, value by value.

Run as a script to check all queries at one scale: ``python -m tests.oracle [sf_dir] [name ...]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

SAME_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def mismatch(df, con, sql: str) -> str | None:
    """What differs between a frame and a query, or None."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = dict(zip(names, [str(c[1]) for c in result.description]))
    want_rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but oracle {sorted(names)}"
    for name, kind in df.dtypes:
        want = SAME_TYPES.get(kind, kind.upper())
        if want != kinds[name]:
            return f"{name} is {want} but oracle {kinds[name]}"
    order = sorted(names)
    at = [names.index(n) for n in order]
    want = Counter(tuple(row[i] for i in at) for row in want_rows)
    got = Counter(tuple(row) for row in df.select(*order).collect())
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return (f"{sum(got.values())} rows but oracle {sum(want.values())}; "
                f"only here {extra}; only oracle {missing}")
    return None


def main(sf_dir: str, wanted: list[str]) -> int:
    from tripmill.catalog import ORACLES, QUERIES
    from tripmill.session import build_session
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in wanted or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = mismatch(df, con, ORACLES[name])
                verdict = "ok" if problem is None else f"MISMATCH {problem}"
            else:
                verdict = f"rows only: {len(df.collect())}"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__} {str(error)[:1500]}"
        bad += "MISMATCH" in verdict or "ERROR" in verdict
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{bad} problems in {len(wanted or QUERIES)} queries")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(1 if main(args[0] if args else "/root/testdata/sf0.01", args[1:]) else 0)
