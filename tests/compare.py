"""Runs registered queries in Spark and DuckDB and compares the rows.

    python tests/compare.py sf0.01 [name ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(spark, con, make, sql, sf_dir):
    """A description of the first difference, or None."""
    df = make(spark, sf_dir)
    names = sorted(df.columns)
    rel = con.sql(sql)
    if names != sorted(rel.columns):
        return f"columns {names} != {sorted(rel.columns)}"
    found = [tuple(r) for r in df.select(*names).collect()]
    expected = rel.project(", ".join(f'"{n}"' for n in names)).fetchall()
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    key = lambda row: tuple((x is not None, str(x) if not isinstance(x, (int, float)) else "", x if isinstance(x, (int, float)) else 0) for x in row)
    found.sort(key=key)
    expected.sort(key=key)
    bad = [(f, e) for f, e in zip(found, expected) if not all(same(x, y) for x, y in zip(f, e))]
    return f"{len(bad)} of {len(found)} rows differ, first {bad[0]}" if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from kindred.session import local_session

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    spark, con = local_session(), connect(sf_dir)
    sqls, makers = entry.oracle_sql(), entry.queries()
    unknown = set(sqls) - set(makers)
    print("without query:", sorted(unknown), "without SQL:", sorted(set(makers) - set(sqls)))
    failed = 0
    for name in sys.argv[2:] or makers:
        start = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, makers[name], sqls[name], sf_dir)
            else:
                problem = None if makers[name](spark, sf_dir).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:26}{time.time() - start:7.2f}s  {problem or ''}", flush=True)
    print("failed:", failed)
