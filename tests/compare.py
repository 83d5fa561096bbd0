"""Run registered queries against their SQL: `python tests/compare.py [sf] [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    return value


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> str:
    """Empty text when the results agree, else what differs."""
    df = fn(spark, sf_dir)
    rows = df.collect()
    if sql is None:
        return "" if rows else "no rows"
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {c[0]: str(c[1]) for c in result.description}
    for column, spark_type in df.dtypes:
        if TYPES.get(spark_type, spark_type) != types[column]:
            return f"type of {column}: {spark_type} != {types[column]}"
    expected = _bag(result.fetchall(), columns)
    found = _bag(rows, df.columns)
    if found == expected:
        return "" if rows else "no rows on either side"
    extra, missing = found - expected, expected - found
    return (
        f"{len(rows)} rows against {expected.total()}; extra {list(extra)[:2]}; "
        f"missing {list(missing)[:2]}"
    )


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from leadpipe.session import build_session

    sf = argv[0] if argv else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle_sql()
    failed = 0
    for name, fn in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, fn, sql.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        mark = "FAIL" if problem else "ok" if name in sql else "rows"
        print(f"{mark:5}{time.time() - start:6.2f}s {name} {problem[:1500]}", flush=True)
    print(f"{failed} failed")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
