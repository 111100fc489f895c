"""Compare registered queries with their SQL in DuckDB: python tests/check_queries.py [sf] [name ...]"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
import __spark_entry__ as E  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def spark_session(cpus: str = "8") -> SparkSession:
    return (SparkSession.builder.master(f"local[{cpus}]").appName("terralattice")
            .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").getOrCreate())


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    return con


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        v = v.replace(tzinfo=None)
    return v


def rows_of(table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(table.column_names)
    kinds = [str(table.schema.field(n).type).replace("large_", "").replace(", tz=UTC", "") for n in names]
    columns = [[_cell(v) for v in table.column(n).to_pylist()] for n in names]
    rows = sorted(zip(*columns), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return names, kinds, rows


def compare(spark: SparkSession, con, d: str, name: str) -> tuple[bool, str, float]:
    start = time.time()
    got = E.queries()[name](spark, d).toArrow()
    took = time.time() - start
    sql = E.oracle_sql().get(name)
    if sql is None:
        return True, f"rows={got.num_rows} (no SQL)", took
    want = con.execute(sql).to_arrow_table()
    gn, gk, gr = rows_of(got)
    wn, wk, wr = rows_of(want)
    if gn != wn:
        return False, f"columns {gn} / {wn}", took
    if len(gr) != len(wr):
        return False, f"rows {len(gr)} / {len(wr)}", took
    bad = [(g, w) for g, w in zip(gr, wr) if g != w]
    if bad:
        return False, f"{len(bad)} of {len(gr)} rows differ, e.g. {bad[0][0]} / {bad[0][1]}", took
    if gk != wk:
        return False, f"types {[(n, a, b) for n, a, b in zip(gn, gk, wk) if a != b]}", took
    return len(gr) > 0, f"rows={len(gr)}", took


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    d = f"/root/testdata/sf{sf}"
    spark, con = spark_session(), connect(d)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in E.queries():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            ok, note, took = compare(spark, con, d, name)
        except Exception as error:  # report and go on
            ok, note, took = False, f"{type(error).__name__}: {str(error)[:600]}", 0.0
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {took:6.2f}s {note}", flush=True)
    print(f"{failed} failed")
