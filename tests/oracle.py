"""Run queries and their SQL twins side by side and report differences.

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
          " labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, con, sf_dir: str, name: str) -> tuple[str | None, int]:
    """(difference or None, number of rows)."""
    df = entry.queries()[name](spark, sf_dir)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None, len(ours)
    con.execute(sql)
    described = con.description
    theirs_columns = [d[0] for d in described]
    theirs = _rows(theirs_columns, con.fetchall())
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(set(df.columns) ^ set(theirs_columns))}", len(ours)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} against {len(theirs)}", len(ours)
    for a, b in zip(ours, theirs):
        if a != b:
            columns = sorted(df.columns)
            diffs = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y or type(x) is not type(y)]
            return f"first difference {diffs[:4]} in {a}", len(ours)
    for i, column in enumerate(sorted(df.columns)):
        kinds = {type(r[i]) for r in ours if r[i] is not None} | {type(r[i]) for r in theirs if r[i] is not None}
        if len(kinds) > 1:
            return f"types of {column}: {kinds}", len(ours)
    return None, len(ours)


def main(sf_dir: str, names: list[str]) -> int:
    from beaconry.session import build_session
    spark = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or list(entry.queries()):
        start = time.time()
        try:
            problem, rows = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={rows} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) != 0)
