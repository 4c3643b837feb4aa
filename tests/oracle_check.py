"""Run registered queries next to their SQL in DuckDB and compare every value."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v) if not isinstance(v, bool) else str(v)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(name, df, con, sql):
    rel = con.execute(sql)
    want = _table([d[0] for d in rel.description], rel.fetchall())
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return ""
    only_got = [r for r in got[1] if r not in set(want[1])][:2]
    only_want = [r for r in want[1] if r not in set(got[1])][:2]
    return f"rows {len(got[1])} != {len(want[1])}\n   spark: {str(only_got)[:700]}\n   sql:   {str(only_want)[:700]}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from broadsheet.session import get_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = get_session(master="local[2]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name, fn in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            sql = oracle_sql().get(name)
            problem = compare(name, df, con, sql) if sql else f"(no sql, {df.count()} rows)"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(problem)
        print(f"{'OK ' if not problem else 'BAD'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print("bad", bad)
