"""Runs a query and its SQL twin and compares names, types and all values."""

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Type names of the two engines that mean the same.
SAME_TYPES = {
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "INTEGER": "int",
}


def connect(sf_dir, tables=TABLES):
    con = duckdb.connect()
    for table in tables:
        path = os.path.join(sf_dir, f"{table}.parquet")
        path = os.path.join(path, "*.parquet") if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v) for v in row))


def differences(df, con, sql):
    """What differs, as text; empty when both results are the same."""
    relation = con.sql(sql)
    kinds = zip(relation.columns, map(str, relation.types))
    want_types = {name: SAME_TYPES.get(kind, kind) for name, kind in kinds}
    got_types = dict(df.dtypes)
    if want_types != got_types:
        return f"types: SQL {want_types}, Spark {got_types}"
    names = sorted(got_types)
    want = _ordered(relation.project(", ".join(f'"{n}"' for n in names)).fetchall())
    got = _ordered(tuple(row) for row in df.select(*names).collect())
    if len(want) != len(got):
        return f"rows: SQL {len(want)}, Spark {len(got)}"
    wrong = [(w, g) for w, g in zip(want, got) if w != g]
    return f"{len(wrong)} of {len(want)} rows differ, first {wrong[0]}" if wrong else ""
