"""Compare queries with their SQL counterpart; also usable from the command line:

python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def normalized(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple("NULL" if pd.isna(v) else _text(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows)


def _text(value) -> str:
    if isinstance(value, float):
        return repr(value)
    return str(value)


def differences(spark, con, fn, sql: str, sf: str) -> str | None:
    got = fn(spark, sf)
    want = con.execute(sql)
    names = sorted(d[0] for d in want.description)
    if sorted(got.columns) != names:
        return f"columns {sorted(got.columns)} != {names}"
    left = pd.DataFrame(got.toArrow().to_pandas(types_mapper=pd.ArrowDtype))
    right = con.execute(sql).to_arrow_table().to_pandas(types_mapper=pd.ArrowDtype)
    types = {n: (str(left[n].dtype), str(right[n].dtype)) for n in names if left[n].dtype != right[n].dtype}
    types = {n: t for n, t in types.items() if not all(x.startswith(("string", "large_string")) for x in t)}
    if types:
        return f"types differ: {types}"
    a, b = normalized(left), normalized(right)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else None


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8, spark__ui__enabled="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in wanted or queries:
        start = time.time()
        try:
            problem = differences(spark, con, queries[name], oracles[name], sf) if name in oracles else "no oracle"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
