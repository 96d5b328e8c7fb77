"""Run a registered query and its SQL on the same tables and compare columns, types and rows.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

TYPES = {
    "BIGINT": "bigint",
    "HUGEINT": "hugeint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def compare(df, con, sql: str) -> tuple[int, list[str]]:
    """The row count and what differs."""
    relation = con.sql(sql)
    ours = {name: dtype for name, dtype in df.dtypes}
    theirs = {name: TYPES.get(str(t), str(t)) for name, t in zip(relation.columns, relation.types)}
    problems = []
    if ours != theirs:
        keys = sorted(ours.keys() | theirs.keys())
        problems.append("types " + ", ".join(f"{k}: {ours.get(k)}/{theirs.get(k)}" for k in keys if ours.get(k) != theirs.get(k)))
    names = sorted(ours)
    left = Counter(tuple(_plain(row[n]) for n in names) for row in df.collect())
    if set(ours) != set(theirs):
        return left.total(), problems
    right = Counter(tuple(_plain(v) for v in row) for row in relation.select(*[f'"{n}"' for n in names]).fetchall())
    if left != right:
        only_left, only_right = list((left - right).items())[:2], list((right - left).items())[:2]
        problems.append(f"rows {left.total()}/{right.total()}: {only_left} / {only_right}"[:1500])
    return left.total(), problems


def main() -> int:
    from layerwright.session import build_session

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(sys.argv[2:])
    spark = build_session(
        master="local[8]",
        settings={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = 0
    for name, query in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            rows, problems = compare(query(spark, sf_dir), con, oracles[name])
        except Exception as error:  # report every query
            rows, problems = -1, [f"{type(error).__name__}: {str(error)[:800]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={rows} {time.time() - start:.1f}s", *problems, flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
