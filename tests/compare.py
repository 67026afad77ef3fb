"""Runs registered queries next to their SQL on DuckDB and compares them as sets of rows."""

from __future__ import annotations

import math
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of_spark(frame: DataFrame) -> tuple[list[str], Counter]:
    columns = sorted(frame.columns)
    rows = frame.select(*[f"`{c}`" for c in columns]).collect()
    return columns, Counter(tuple(plain(v) for v in r) for r in rows)


def rows_of_duckdb(con, sql: str) -> tuple[list[str], Counter, dict[str, str]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    return [names[i] for i in order], rows, {d[0]: str(d[1]) for d in result.description}


def differences(frame: DataFrame, con, sql: str) -> str:
    """Empty text when both agree in column names and rows."""
    columns, spark_rows = rows_of_spark(frame)
    names, duck_rows, _ = rows_of_duckdb(con, sql)
    if columns != names:
        return f"columns {columns} != {names}"
    if spark_rows != duck_rows:
        left, right = spark_rows - duck_rows, duck_rows - spark_rows
        return f"{sum(left.values())}/{sum(right.values())} rows differ: {list(left)[:3]} != {list(right)[:3]}"
    return ""


if __name__ == "__main__":
    import sys

    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from panelwright.session import local_session
    import workload

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(workload.QUERIES)
    spark, con = local_session(), connect(sf)
    for name in wanted:
        started = time.time()
        try:
            frame = workload.QUERIES[name](spark, sf)
            if name in workload.ORACLES:
                outcome = differences(frame, con, workload.ORACLES[name])
                types = {d[0]: str(d[1]) for d in con.execute(workload.ORACLES[name]).description}
                mine = {f.name: f.dataType.simpleString() for f in frame.schema}
                outcome = outcome or f"ok {[(c, mine[c], types[c]) for c in mine]}"
            else:
                outcome = f"rows only: {frame.count()} {frame.columns}"
        except Exception as error:  # noqa: BLE001
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:26s} {time.time() - started:6.2f}s  {outcome}", flush=True)
    spark.stop()
