"""Run a registered query and its SQL, and compare columns, types and rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER"}


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def differences(spark_df, con, sql: str) -> list[str]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    expected = cur.fetchall()
    got = spark_df.collect()
    problems = []
    if sorted(spark_df.columns) != sorted(names):
        return [f"columns {sorted(spark_df.columns)} vs {sorted(names)}"]
    for name, kind in spark_df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            problems.append(f"{name}: {kind} vs {kinds[name]}")
    order = sorted(names)
    a = Counter(tuple(_cell(r[c]) for c in order) for r in got)
    idx = [names.index(c) for c in order]
    b = Counter(tuple(_cell(r[i]) for i in idx) for r in expected)
    if a != b:
        problems.append(f"rows {len(got)} vs {len(expected)}; only spark {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}")
    return problems
