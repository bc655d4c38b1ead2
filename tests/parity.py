"""Run registered plans and compare them with their SQL on DuckDB.

    python tests/parity.py [--sf 0.01] [key or prefix ...]
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _cells(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def cell(v):
        if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and getattr(v, "ndim", 0):
            return repr([cell(x) for x in v])
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return "null"
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, bool):
            return repr(v)
        if isinstance(v, float):
            return repr(v)
        return str(v)

    rows = [tuple(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None)]
    return sorted(rows)


def _kind(dtype) -> str:
    return {"i": "int", "u": "int", "f": "float", "b": "bool", "M": "time", "O": "object"}.get(dtype.kind, "object")


def compare(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = got.copy(), want.copy()
    for c in got.columns:
        if want[c].dtype == "Int64" and got[c].dtype == "float64" and got[c].isna().any():  # whole numbers with nulls come as floats from one side
            got[c] = got[c].astype("Int64")
        a, b = _kind(got[c].dtype), _kind(want[c].dtype)
        if a != b and "object" not in (a, b) and len(got):
            return f"column {c}: {got[c].dtype} vs {want[c].dtype}"
    a, b = _cells(got), _cells(want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ ({sorted(got.columns)}), e.g.\n   spark {bad[0][0]}\n   sql   {bad[0][1]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from lodestat.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = build_session("local[8]", 8, **{"spark.driver.memory": "8g"})
    con = connect(folder)
    plans, sql = entry.queries(), entry.oracle_sql()
    chosen = [k for k in plans if not args.keys or any(k == a or (a.endswith("*") and k.startswith(a[:-1])) for a in args.keys)]
    failed = 0
    for key in chosen:
        start = time.time()
        try:
            got = plans[key](spark, folder).toPandas()
            took = time.time() - start
            note = "rows only" if key not in sql else compare(got, con.execute(sql[key]).df())
        except Exception as error:  # noqa: BLE001
            took = time.time() - start
            note = "".join(traceback.format_exception_only(error))[:700]
            got = []
        bad = note not in (None, "rows only")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {key:32s} {len(got):7d} rows {took:6.2f}s {note or ''}", flush=True)
    print(f"{len(chosen)} run, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
