"""Run a registered query and its comparison SQL and compare every value.

python -m tests.compare [--dir FOLDER] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback
from collections import Counter

import duckdb

import __spark_entry__ as entry
from isobar.plans.adapter import TABLES
from isobar.session import local_session


def sql_engine(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(v):
    if isinstance(v, float):
        return "nan" if v != v else v + 0.0
    return v


def compare(spark, con, name: str, folder: str, allow_empty: bool = False, look=None) -> list[str]:
    """Differences found; empty when equal."""
    df = entry.queries()[name](spark, folder)
    if look:
        look(df)
    got = _rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return [] if sum(got.values()) else ["no rows"]
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = _rows(columns, cur.fetchall())
    out = []
    if sorted(columns) != sorted(df.columns):
        out.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
    if sum(got.values()) != sum(want.values()):
        out.append(f"{sum(got.values())} rows != {sum(want.values())}")
    if got != want:
        out.append(f"only here {list((got - want).items())[:3]}")
        out.append(f"only there {list((want - got).items())[:3]}")
    if not want and not allow_empty:
        out.append("no rows")
    kinds = dict(df.dtypes)
    for d in cur.description:
        k = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}.get(
            kinds.get(d[0], ""), "?")
        if str(d[1]).upper() not in (k, kinds.get(d[0], "").upper(), {"INTEGER": "INT32"}.get(k, k)) and "NUMBER" not in str(d[1]).upper() \
                and "STRING" not in str(d[1]).upper():
            out.append(f"type of {d[0]}: {kinds.get(d[0])} / {d[1]}")
    return out


def main() -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--dir", default="/root/testdata/sf0.01")
    p.add_argument("names", nargs="*")
    a = p.parse_args()
    spark = local_session(8)
    con = sql_engine(a.dir)
    failed = 0
    for name in a.names or entry.queries():
        start = time.time()
        try:
            diffs = compare(spark, con, name, a.dir)
        except Exception as e:
            diffs = ["".join(traceback.format_exception_only(e))[:600]]
        failed += bool(diffs)
        print(f"{'DIFF' if diffs else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        for d in diffs:
            print("     ", d[:700], flush=True)
    print(f"{failed} different")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
