"""Run a registered query and its SQL on the same files and compare as row multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9) + 0.0
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, int):
        return x
    return str(x)


def compare(spark, con, name, fn, sql, sf_dir) -> list[str]:
    """Problems found, empty when both sides agree."""
    problems = []
    df = fn(spark, sf_dir)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    if sorted(cols) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(cols)}"]
    order = sorted(cols)
    expect = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for c, kind in df.dtypes:
        if expect.get(kind) != kinds[c]:
            problems.append(f"type of {c}: {kind} vs {kinds[c]}")
    theirs = Counter(tuple(_cell(row[cols.index(c)]) for c in order) for row in cur.fetchall())
    ours = Counter(tuple(_cell(row[c]) for c in order) for row in df.collect())
    if ours != theirs:
        a, b = list((ours - theirs).elements()), list((theirs - ours).elements())
        problems.append(f"rows {sum(ours.values())} vs {sum(theirs.values())}; only spark {len(a)} {a[:3]}; "
                        f"only sql {len(b)} {b[:3]}; columns {order}")
    if not ours:
        problems.append("no rows")
    return problems
