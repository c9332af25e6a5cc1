"""Run registered queries and compare them with their SQL in DuckDB. Also usable from the command line:
python tests/oracle.py [sf] [query ...]"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
ROOT = "/root/testdata"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if not isinstance(v, (str, bool)) else v


def table(cols: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def difference(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    df = fn(spark, sf_dir)
    left = table(df.columns, df.collect())
    res = con.execute(sql)
    right = table([d[0] for d in res.description], res.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} vs {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from riskloom.session import local_session

    sf_dir = f"{ROOT}/{argv[0] if argv else 'sf0.01'}"
    chosen = argv[1:] or list(queries())
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            if name in oracle_sql():
                note = difference(spark, con, queries()[name], oracle_sql()[name], sf_dir) or "ok"
            else:
                rows = queries()[name](spark, sf_dir).collect()
                note = f"rows {len(rows)}, first {rows[0] if rows else None}"
        except Exception as e:  # noqa: BLE001
            note = f"error {type(e).__name__}: {str(e)[:600]}"
        failed += note.startswith(("error", "columns", "rows differ")) or "differ" in note
        print(f"{name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
