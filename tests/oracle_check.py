"""Run registered queries next to their SQL in DuckDB and compare names, types and values.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SAME_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(("|".join(repr(r[i]) for i in order) for r in rows))


def compare(spark, con, sf_dir: str, query, sql: str) -> str:
    """Empty text when equal, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    df = query(spark, sf_dir)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kinds[name], kinds[name]) != kind:
            return f"type of {name}: spark {kind}, sql {kinds[name]}"
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(names, expected)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            bad = sum(x != y for x, y in zip(got, want))
            return f"{bad} rows differ, first: {a} vs {b}"
    if not got:
        return "no rows at all"
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from learnlake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, sf_dir, query, oracle[name])
            else:
                problem = "" if query(spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        kind = "sql" if name in oracle else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {kind:4s} {time.time() - start:6.2f}s {problem}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
