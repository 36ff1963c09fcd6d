"""Run named queries against their SQL: python tests/check_oracle.py [sf] [name ...].

With PLAIN=1 in the environment the session has Spark's defaults.
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from editengine.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(rows, order):
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(df, con, sql: str) -> str:
    """'' when equal, else the first difference."""
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    types = {c[0]: str(c[1]) for c in found.description}
    rows = found.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    mine = {f.name: KIND.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    wrong = {c: (mine[c], types[c]) for c in names if mine[c] != types[c]}
    ours = [tuple(r) for r in df.collect()]
    order = sorted(names)
    a = canonical(ours, [df.columns.index(c) for c in order])
    b = canonical(rows, [names.index(c) for c in order])
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{order}\n   spark {x}\n   sql   {y}"
    return f"types {wrong}" if wrong else ""


def main() -> int:
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(entry.queries())
    if os.environ.get("PLAIN"):  # a session that knows nothing of this package
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                              spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name in names:
        begin = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in sql:
                problem = compare(df, con, sql[name])
                count = ""
            else:
                problem, count = "", f"{len(df.collect())} rows, no SQL"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {time.time() - begin:6.2f}s {problem or count}", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")
    return failed


if __name__ == "__main__":
    sys.exit(main())
