"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names, and an order-insensitive multiset of normalised
rows (columns sorted by name).

Run directly for a report over every registered query:
``python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in DRIVER_TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(table) -> tuple[list[str], Counter]:
    names = list(table.column_names)
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [table.column(i).to_pylist() for i in order]
    return [names[i] for i in order], Counter(tuple(_norm(c[r]) for c in cols) for r in range(table.num_rows))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry

    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_table = sdf.toArrow()
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    result = {"name": name, "spark_rows": s_table.num_rows, "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        result["match"] = None
        return result
    d_table = con.sql(sql).to_arrow_table()
    s_names, s_rows = rows_of(s_table)
    d_names, d_rows = rows_of(d_table)
    result.update(
        oracle_rows=d_table.num_rows,
        names_equal=s_names == d_names,
        values_equal=s_rows == d_rows,
    )
    result["match"] = result["names_equal"] and result["values_equal"] and s_table.num_rows == d_table.num_rows
    if not result["names_equal"]:
        result["names"] = (s_names, d_names)
    elif not result["values_equal"]:
        only_s = list((s_rows - d_rows).elements())[:3]
        only_d = list((d_rows - s_rows).elements())[:3]
        result["diff"] = {"spark_only": only_s, "oracle_only": only_d, "names": s_names}
    result["spark_types"] = [f.dataType.simpleString() for f in sorted(sdf.schema.fields, key=lambda f: f.name)]
    result["oracle_types"] = [str(d_table.schema.field(n).type) for n in d_names]
    return result


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from vialflow.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(entry.queries())
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            r = compare(spark, name, sf_dir, con)
        except Exception as exc:  # report and continue with the next query
            r = {"name": name, "match": False, "error": repr(exc)[:600]}
        bad += r.get("match") is False
        extra = {k: r[k] for k in ("diff", "names", "error") if k in r}
        print(f"{name:24s} match={r.get('match')} rows={r.get('spark_rows')}/{r.get('oracle_rows')} "
              f"t={r.get('spark_sec')} {extra if extra else ''}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
