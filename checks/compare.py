"""Run registered queries next to their DuckDB SQL and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from datetime import datetime


def _cell(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return f"{value:.5f}" if value == value else "nan"
    if isinstance(value, datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, sf_dir, name, query, sql):
    """None when equal, else a short text of the first difference."""
    df = query(spark, sf_dir)
    got, columns = rows_of(df.columns, [tuple(r) for r in df.collect()])
    out = con.execute(sql)
    want, expected = rows_of([d[0] for d in out.description], out.fetchall())
    if columns != expected:
        return f"columns {sorted(set(columns) ^ set(expected))}"
    if got == want:
        return None
    extra, lacking = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    text = f"rows {len(got)} vs {len(want)}; only here {len(extra)}, only there {len(lacking)}"
    if extra and lacking:
        differing = [(c, a, b) for c, a, b in zip(columns, extra[0], lacking[0]) if a != b]
        text += f"; first: {differing[:6]}"
    return text


def main(argv):
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    from tidemark.session import local_session

    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(argv[0])
    failed = 0
    for name, query in QUERIES.items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            problem = (
                compare(spark, con, argv[0], name, query, ORACLE[name])
                if name in ORACLE
                else f"no SQL, {query(spark, argv[0]).count()} rows"
            )
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
