"""Compare a registered query's Spark result with its SQL oracle on DuckDB:
row count, column names and an order-insensitive value digest."""

from __future__ import annotations

import hashlib
import math

from oreflow.sources.tables import TABLES, table_path


def norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.6g}"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if "datetime" in type(v).__name__ else v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark, con, sf_dir: str, fn, sql: str):
    """Returns (ok, message)."""
    sdf = fn(spark, sf_dir)
    srows, scols = [tuple(r) for r in sdf.collect()], sdf.columns
    cur = con.execute(sql)
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    hs, ls = digest(scols, srows)
    hd, ld = digest(dcols, drows)
    ok = len(srows) == len(drows) and sorted(scols) == sorted(dcols) and hs == hd
    msg = (f"spark {len(srows)} rows {sorted(scols)} / sql {len(drows)} rows {sorted(dcols)}; "
           f"spark-only {sorted(set(ls) - set(ld))[:2]} sql-only {sorted(set(ld) - set(ls))[:2]}")
    return ok, msg
