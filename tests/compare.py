"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(rows: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of plain values, columns by name."""
    rows = rows[sorted(rows.columns)]
    out = []
    for row in rows.astype(object).where(rows.notna(), None).itertuples(index=False):
        out.append(tuple(None if v is None else plain(v) for v in row))
    return sorted(out, key=repr)


def plain(value):
    if isinstance(value, bool):
        return value
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, float):
        return repr(value + 0.0)
    if hasattr(value, "item"):
        return plain(value.item())
    return value


def compare(spark, connection, sf_dir: str, name: str, run, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    ours, theirs = run(spark, sf_dir).toPandas(), connection.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"{name}: columns {sorted(ours.columns)} against {sorted(theirs.columns)}"
    left, right = canonical(ours), canonical(theirs)
    if left == right:
        return None
    wrong = [pair for pair in zip(left, right) if pair[0] != pair[1]]
    return f"{name}: {len(left)} and {len(right)} rows, {len(wrong)} differ, first {wrong[:1]}"


if __name__ == "__main__":
    from checks import ORACLES, QUERIES
    from riskloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    session = local_session(8)
    session.sparkContext.setLogLevel("OFF")
    database = duck(folder)
    for query_name in wanted:
        started = time.time()
        try:
            if query_name in ORACLES:
                problem = compare(
                    session, database, folder, query_name, QUERIES[query_name], ORACLES[query_name]
                )
                verdict = problem or "ok"
            else:
                verdict = f"{QUERIES[query_name](session, folder).count()} rows"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__}: {str(error)[:300]}"
        print(f"{query_name:22s} {time.time() - started:6.1f}s  {verdict}", flush=True)
