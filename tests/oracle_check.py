"""Run registered queries next to their checking SQL and compare all rows.

    python tests/oracle_check.py [sf_dir] [name part ...]
"""
from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        return (2, "nan" if isinstance(v, float) and math.isnan(v) else repr(float(v)))
    return (3, str(v))


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(_cell(r[k]) for k in order) for r in rows)


_TYPES = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean",
          "TIMESTAMP": "timestamp_ntz", "DATE": "date"}


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs: names, types or rows."""
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    got_types = dict(spark_df.dtypes)
    for name, kind in ((d[0], str(d[1])) for d in cur.description):
        if name in got_types and _TYPES.get(kind, kind) != got_types[name]:
            return f"type of {name}: spark {got_types[name]}, sql {kind}"
    want = _rows(cur.fetchall(), want_names)
    got_names = spark_df.columns
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    got = _rows(spark_df.collect(), got_names)
    if got == want:
        return None
    extra = [r for r in got if r not in set(want)][:3]
    missing = [r for r in want if r not in set(got)][:3]
    return f"rows {len(got)} vs {len(want)}\n   only spark {extra}\n   only sql   {missing}"


def main() -> int:
    import __spark_entry__ as entry
    from bazaarlens.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else None
            note = "" if name in oracles else f"(rows only: {df.count()})"
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem, note = f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:34s} {time.time() - start:6.2f}s {note}{problem or ''}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
