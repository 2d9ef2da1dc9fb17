"""Run registered queries next to their SQL and compare all values.

    python -m tests.compare /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        if Path(f"{sf}/{t}.parquet").exists():
            con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def compare(names, rows, expected_names, expected):
    if sorted(names) != sorted(expected_names):
        return f"columns {sorted(names)} != {sorted(expected_names)}"
    at, expected_at = ([n.index(c) for c in sorted(n)] for n in (names, expected_names))
    a = Counter(tuple(plain(r[i]) for i in at) for r in rows)
    b = Counter(tuple(plain(r[i]) for i in expected_at) for r in expected)
    if a == b:
        return None
    return f"rows {sum(a.values())} vs {sum(b.values())}; only here {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"


def check(spark, sf, name, con):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        return None, len(rows)
    result = con.execute(sql)
    return compare(df.columns, rows, [d[0] for d in result.description], result.fetchall()), len(rows)


def main():
    from __spark_entry__ import queries
    from jouleloom.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf, names = sys.argv[1], sys.argv[2:] or list(queries())
    con = connect(sf)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem, n = check(spark, sf, name, con)
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={n} {time.time() - start:.1f}s {problem or ''}"[:1500], flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main()
