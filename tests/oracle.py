"""Run registered queries beside their SQL and compare the rows.

``python tests/oracle.py [-d folder] [name-prefix ...]``
"""

from __future__ import annotations

import argparse
import datetime
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
    "float": "FLOAT",
}


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(0.0 if value == 0 else value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """None if both sides agree, else what differs."""
    rows = [tuple(r) for r in df.collect()]
    done = con.execute(sql)
    names = [c[0] for c in done.description]
    kinds = {c[0]: str(c[1]) for c in done.description}
    expected = done.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = [
        f"{c}: {t} vs {kinds[c]}" for c, t in df.dtypes if SAME_TYPE.get(t, "?") != kinds[c]
    ]
    if types:
        return f"types {types}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} != {len(expected)}"
    if not rows:
        return "no rows on either side"
    ours, theirs = canonical(df.columns, rows), canonical(names, expected)
    if ours != theirs:
        wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
        return f"{len(wrong)} rows differ, {sorted(names)}: {wrong[:2]}"
    return None


def main():
    import __spark_entry__ as contract
    from finflow.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("-d", "--folder", default="/root/testdata/sf0.01")
    parser.add_argument("prefixes", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "oracle", "local[8]", spark__ui__enabled="false", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(args.folder), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if args.prefixes and not any(name.startswith(p) for p in args.prefixes):
            continue
        began = time.time()
        try:
            df = run(spark, args.folder)
            if name in oracles:
                verdict = compare(df, con, oracles[name])
            else:
                verdict = None if df.count() else "no rows"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None
        kind = "S" if name in oracles else "R"
        print(f"{'ok ' if verdict is None else 'BAD'} {kind} {time.time() - began:6.2f}s {name} {verdict or ''}", flush=True)
    print("bad:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
