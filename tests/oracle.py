"""Side-by-side run of a registered query and its SQL.

``python tests/oracle.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir) -> list[str]:
    """Faults found; an empty list means equal columns, types and rows."""
    df = fn(spark, sf_dir)
    got = df.collect()
    relation = con.execute(sql)
    columns = [d[0] for d in relation.description]
    want = relation.fetchall()
    faults = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    types = {c[0]: c[1] for c in con.execute("describe " + sql).fetchall()}
    same = {
        "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
        "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
    }
    for field in df.schema:
        if same.get(types[field.name]) != field.dataType.simpleString():
            faults.append(f"type {field.name}: {field.dataType.simpleString()} vs {types[field.name]}")
    left, right = _rows(df.columns, got), _rows(columns, want)
    if left != right:
        only_l = [r for r in left if r not in set(right)][:3]
        only_r = [r for r in right if r not in set(left)][:3]
        faults.append(f"rows {len(left)} vs {len(right)}; {sorted(df.columns)}; spark {only_l} sql {only_r}")
    return faults


def main() -> int:
    from scoreloom.catalog import ORACLES, QUERIES
    from scoreloom.config import session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or list(QUERIES)
    spark = session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.monotonic()
        try:
            if name in ORACLES:
                faults = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
            else:
                rows = QUERIES[name](spark, sf_dir).collect()
                faults = [] if rows else ["no rows"]
        except Exception as exc:
            faults = [f"{type(exc).__name__}: {str(exc)[:1500]}"]
        bad += bool(faults)
        print(f"{'FAIL' if faults else 'ok  '} {name} {time.monotonic() - start:.1f}s {' | '.join(faults)}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
