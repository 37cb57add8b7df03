"""Compare registered queries with their SQL twins: names, kinds, row counts, values.

    python tools/check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def normal(value):
    """Value in a form both engines share."""
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(normal(r[i]) for i in order) for r in rows]


def compare(spark_columns, spark_rows, sql_columns, sql_rows) -> str:
    if sorted(spark_columns) != sorted(sql_columns):
        return f"COLUMNS {sorted(spark_columns)} != {sorted(sql_columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"ROWS {len(spark_rows)} != {len(sql_rows)}"
    a = sorted(rows_of(spark_columns, spark_rows), key=repr)
    b = sorted(rows_of(sql_columns, sql_rows), key=repr)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        return f"VALUES {len(diff)} differ, first {str(diff[0])[:700]}"
    for i, name in enumerate(sorted(spark_columns)):
        kinds = ({kind(r[i]) for r in a if r[i] is not None}, {kind(r[i]) for r in b if r[i] is not None})
        if kinds[0] != kinds[1]:
            return f"KINDS {name} {kinds}"
    return "ok"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--module", default=None, help="only this catalog module")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"

    from vacancia.catalog import registry
    from vacancia.session import local_session

    if args.module:
        importlib.import_module(f"vacancia.catalog.{args.module}")
        queries, oracles = registry.QUERIES, registry.ORACLES
    else:
        spark_entry = importlib.import_module("__spark_entry__")
        queries, oracles = spark_entry.queries(), spark_entry.oracle_sql()
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name, run in queries.items():
        if args.names and name not in args.names:
            continue
        if args.module and not run.__module__.endswith(args.module):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            verdict, sql_took = "rows only", 0.0
            if name in oracles:
                start = time.time()
                cursor = db.execute(oracles[name])
                columns = [c[0] for c in cursor.description]
                expected = cursor.fetchall()
                sql_took = time.time() - start
                verdict = compare(df.columns, rows, columns, expected)
            if not rows:
                verdict += " EMPTY"
        except Exception as e:
            verdict, took, sql_took, rows = f"ERROR {type(e).__name__}: {str(e)[:900]}", 0, 0, []
        bad += verdict not in ("ok", "rows only")
        print(f"{name:22s} {len(rows):8d} rows  spark {took:6.2f}s  sql {sql_took:6.2f}s  {verdict}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
