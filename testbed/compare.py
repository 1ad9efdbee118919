"""Compare a query with its reference SQL in DuckDB, order-insensitively.

Usage: python -m testbed.compare SF_DIR [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime

import duckdb

PARQUET = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in PARQUET:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, (int, str)):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return str(v)


def canonical(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, otherwise a short description."""
    cur = con.execute(sql)
    want_cols, want = canonical([d[0] for d in cur.description], cur.fetchall())
    kinds = {d[0]: str(d[1]) for d in cur.description}
    got_cols, got = canonical(spark_df.columns, spark_df.collect())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    n, m = sum(got.values()), sum(want.values())
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}
    types = [
        f"{c}: {t} != {kinds[c]}" for c, t in spark_df.dtypes
        if t in names and names[t] != kinds[c] and not (kinds[c] == "STRING" and t == "string") and kinds[c] != "NUMBER"
    ]
    if got == want:
        return None if not types or n == 0 else f"rows equal, types differ: {types}"
    only_got, only_want = got - want, want - got
    return f"rows {n} vs {m}; only spark {list(only_got.items())[:3]}; only duckdb {list(only_want.items())[:3]}; {got_cols}; differing {sum(only_got.values())}"


def main(argv: list[str]) -> int:
    from adtally.session import build_session
    from testbed import ORACLES, QUERIES

    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                verdict = difference(df, con, ORACLES[name])
                size = ""
            else:
                verdict, size = None, f"(rows only: {df.count()})"
        except Exception as e:  # report and go on
            verdict, size = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += verdict is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if verdict is None else 'DIFF ' + verdict} {size}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
