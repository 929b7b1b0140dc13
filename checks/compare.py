"""Run registered queries beside their DuckDB text and report differences."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else ("f", v + 0.0)
    if isinstance(v, Decimal):
        return ("f", float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = df.collect()
    cur = con.execute(sql)
    want_cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    a, b = rows_of(df.columns, [tuple(r) for r in got]), rows_of(want_cols, want)
    if a == b:
        return None if got else "both empty"
    only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
    return f"rows {len(got)} vs {len(want)}; {sorted(df.columns)}\n   spark only {only_a}\n   duckdb only {only_b}"


def main(sf_dir: str, names: list[str]) -> int:
    from checks import ORACLE, QUERIES
    from tidemark.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false",
                                                "spark.ui.showConsoleProgress": "false",
                                                "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or list(QUERIES):
        t = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                diff = compare(df, con, ORACLE[name])
            else:
                n = df.count()
                diff = None if n else "empty"
            state = "ok" if diff is None else f"DIFF {diff}"
        except Exception as e:
            state = f"ERROR {type(e).__name__} {str(e)[:600]}"
        bad += state != "ok"
        kind = "o" if name in ORACLE else "r"
        print(f"{name:28s} {kind} {time.time() - t:6.2f}s {state}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
