"""Run registered queries and their SQL on the same tables and compare all rows.

    python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.queries import QUERIES
from checks.sql import SQL
from reckoner.session import local_session


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> str:
    """Empty when columns and rows agree, otherwise what differs."""
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    if got == want:
        return "" if got else "no rows"
    return (
        f"{sum((got - want).values())} of {sum(got.values())} rows only in Spark {list(got - want)[:2]}, "
        f"{sum((want - got).values())} only in SQL {list(want - got)[:2]}"
    )


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, failed = local_session(8), connect(folder), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        started = time.time()
        try:
            problem = difference(spark, con, folder, name)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{name:32} {time.time() - started:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
