"""Run registered queries and their SQL side by side and compare values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same column names and rows."""
    spark_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    duck_rows = _rows([c[0] for c in result.description], result.fetchall())
    if spark_rows[0] != duck_rows[0]:
        return f"columns {spark_rows[0]} against {duck_rows[0]}"
    if spark_rows[1] == duck_rows[1]:
        return None
    left, right = set(spark_rows[1]), set(duck_rows[1])
    return (
        f"rows {len(spark_rows[1])} against {len(duck_rows[1])}\n  only here: {sorted(left - right)[:2]}"
        f"\n  only sql:  {sorted(right - left)[:2]}"
    )


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from kerbside.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                diff = difference(df, con, sql[name])
            else:
                diff = None if df.count() else "no rows"
        except Exception as e:  # noqa: BLE001
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} {time.time() - start:.1f}s {diff or ''}", flush=True)
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
