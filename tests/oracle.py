"""Compare a registered query with its SQL counterpart run by DuckDB on the same files."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(folder, name)}.parquet')")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return "~nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def compare(spark, folder: str, query) -> list[str]:
    """Differences between both results; empty when names, row counts and all values agree."""
    got = query.run(spark, folder)
    names = sorted(got.columns)
    rows = sorted(tuple(_cell(r[n]) for n in names) for r in got.collect())
    result = connect(folder).execute(query.sql)
    sql_names = [d[0] for d in result.description]
    if sorted(sql_names) != names:
        return [f"columns {names} against {sorted(sql_names)}"]
    order = [sql_names.index(n) for n in names]
    expected = sorted(tuple(_cell(r[i]) for i in order) for r in result.fetchall())
    if len(rows) != len(expected):
        return [f"{len(rows)} rows against {len(expected)}"]
    return [f"{a} against {b}" for a, b in zip(rows, expected) if a != b]


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from sparkmart.plans.catalog import all_queries
    from sparkmart.session import build_session

    session = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    session.sparkContext.setLogLevel("ERROR")
    data = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    for name, q in all_queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            if q.sql:
                bad = compare(session, data, q)
                state = "ok" if not bad else f"DIFF {len(bad)}: {bad[:3]}"
            else:
                state = f"rows {len(q.run(session, data).collect())}"
        except Exception as error:  # noqa: BLE001
            state = f"ERROR {str(error)[:600]}"
        print(f"{name:34s} {time.time() - start:6.2f}s {state}", flush=True)
