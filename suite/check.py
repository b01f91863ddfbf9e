"""Compare every query with its SQL: ``python -m suite.check [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time

import pandas as pd


def normal(value) -> str:
    if value is None or value is pd.NaT:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value + 0.0)
    if hasattr(value, "item"):
        return normal(value.item())
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    return repr(value)


def rows_of(columns, tuples) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in tuples)


def compare(spark_df, connection, sql: str) -> str | None:
    """None if equal, else what differs."""
    got_columns = spark_df.columns
    got = rows_of(got_columns, [tuple(r) for r in spark_df.collect()])
    cursor = connection.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = rows_of(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} and {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows"
    different = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(different)} of {len(got)} rows, first {different[0]}" if different else None


def connect(sf_dir: str):
    import duckdb

    names = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
    connection = duckdb.connect()
    for name in names.split():
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def main() -> None:
    from barframe.session import build_session
    from suite.oracles import ORACLES
    from suite.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = compare(df, connection, ORACLES[name]) if name in ORACLES else None
            if name not in ORACLES:
                print(name, df.collect())
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")


if __name__ == "__main__":
    main()
