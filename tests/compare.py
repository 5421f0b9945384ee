"""Order-free comparison of a Spark query with its checking SQL."""

import duckdb

from opstide.catalog.bindings import TABLES

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ""
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def _rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


def compare(df, con, sql):
    """(status, detail): status is ok, EMPTY or FAIL."""
    got = df.collect()
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return "FAIL", f"columns {sorted(df.columns)} vs {sorted(columns)}"
    a, b = _rows(df.columns, got), _rows(columns, want)
    odd = [f"{c}:{t}/{types[c]}" for c, t in df.dtypes if SPARK_TO_DUCK.get(t) != types[c]]
    note = f" types {odd}" if odd else ""
    if a != b:
        in_a, in_b = set(a), set(b)
        only = [x for x in a if x not in in_b][:2]
        other = [x for x in b if x not in in_a][:2]
        return "FAIL", f"{len(a)} vs {len(b)} rows; {sorted(columns)}\n   spark {only}\n   check {other}{note}"
    return ("ok" if got else "EMPTY"), f"{len(a)} rows{note}"
