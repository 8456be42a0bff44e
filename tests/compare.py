"""Run registered queries next to their SQL twins.

    python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return ("0",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return ("n", "nan") if math.isnan(v) else ("n", v + 0.0)
    if isinstance(v, int):
        return ("n", float(v))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return ("t", v.isoformat())
    return ("s", str(v))


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    order = sorted(names)
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = sorted(tuple(cell(r[names.index(c)]) for c in order) for r in result.fetchall())
    got = sorted(tuple(cell(r[c]) for c in order) for r in df.select(*order).collect())
    if len(expected) != len(got):
        return f"{len(got)} rows, expected {len(expected)}"
    bad = [(g, e) for g, e in zip(got, expected) if g != e]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {dict(zip(order, bad[0][0]))} / {dict(zip(order, bad[0][1]))}"
    same = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [
        f"{c}: {t} / {kinds[c]}" for c, t in df.dtypes if t in same and same[t] != kinds[c]
    ]
    if odd:
        return f"types {odd}"
    return None


def main() -> int:
    from panelweave.session import build_session
    from queries import QUERIES, SQL

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", 8, **{"spark__driver__memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name in names:
        begin = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in SQL:
                verdict = compare(df, con, SQL[name]) or "ok"
            else:
                verdict = f"rows only: {len(df.collect())} rows"
        except Exception as e:  # noqa: BLE001 - report and go on
            verdict = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        failed += not verdict.startswith(("ok", "rows only"))
        print(f"{name:32s} {time.time() - begin:6.2f}s  {verdict}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
