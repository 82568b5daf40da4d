"""Order-insensitive comparison of a Spark result with its DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')").fetchall()
    con.execute("SET TimeZone='UTC'").fetchall()
    return con


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    cols = spark_df.columns
    rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    h1, l1 = digest(cols, rows)
    h2, l2 = digest(ocols, orows)
    if sorted(cols) != sorted(ocols):
        return False, f"columns {sorted(cols)} != {sorted(ocols)}"
    if len(rows) != len(orows):
        return False, f"rows {len(rows)} != {len(orows)}"
    if h1 != h2:
        extra = sorted(set(l1) - set(l2))[:2]
        missing = sorted(set(l2) - set(l1))[:2]
        return False, f"values differ: spark only {extra} duckdb only {missing}"
    return True, f"{len(rows)} rows"
