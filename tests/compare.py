"""Run registered queries and their SQL side by side on one table directory.

usage: python tests/compare.py [dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(value):
    if value is None:
        return ("", "null")
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        if math.isnan(value):
            return ("f", "nan")
        return ("f", f"{value:.6g}" if abs(value) > 1e6 else round(value, 6) + 0.0)
    if isinstance(value, int):
        return ("i", value)
    return ("s", str(value))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_norm(r[i]) for i in order) for r in rows], key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    rel = con.sql(sql)
    want_cols, want = list(rel.columns), rel.fetchall()
    got = spark_df.collect()
    if sorted(want_cols) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(want_cols)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = canonical(spark_df.columns, got), canonical(want_cols, want)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, first {str(bad[0][0])[:300]} vs {str(bad[0][1])[:300]}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as e
    from textkg.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = e.queries(), e.oracle_sql()
    names = argv[1:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                message = difference(df, con, oracles[name])
                n = ""
            else:
                message, n = None, f"{df.count()} rows, no SQL"
        except Exception as ex:  # report and go on with the next query
            message, n = f"{type(ex).__name__}: {str(ex)[:600]}", ""
        failed += message is not None
        print(f"{'FAIL' if message else 'ok  '} {name} {time.time() - start:.1f}s {message or n}", flush=True)
    print(f"{failed} failed of {len(names)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
