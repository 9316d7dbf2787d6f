"""Runs a query and its SQL counterpart and compares them value by value."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _canonical(rows):
    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in rows)


def compare(df, con, sql):
    """Returns (number of rows, list of differences)."""
    names = sorted(df.columns)
    mine = _canonical(df.select(*[f"`{c}`" for c in names]).collect())
    relation = con.sql(sql)
    if sorted(relation.columns) != names:
        return len(mine), [f"columns {names} against {sorted(relation.columns)}"]
    quoted = ", ".join(f'"{c}"' for c in names)
    theirs = _canonical(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    diff = []
    if len(mine) != len(theirs):
        diff.append(f"{len(mine)} rows against {len(theirs)}")
    diff += [f"{a} against {b}" for a, b in zip(mine, theirs) if a != b][:5]
    types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    names_of = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}
    for c in names:
        if names_of.get(spark_types[c]) != types[c]:
            diff.append(f"type of {c}: {spark_types[c]} against {types[c]}")
    return len(mine), diff
