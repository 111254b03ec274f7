"""Compare every named query with its SQL counterpart in DuckDB.

``python -m tests.compare [table folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    return value


def bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str:
    """Empty when columns and the bag of rows are equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    left, right = bag(df.columns, [tuple(r) for r in df.collect()]), bag(names, result.fetchall())
    if left == right:
        return ""
    only_spark, only_sql = left - right, right - left
    return (
        f"rows {sum(left.values())} != {sum(right.values())}; "
        f"only spark {list(only_spark)[:2]} ({len(only_spark)}); only sql {list(only_sql)[:2]} ({len(only_sql)})"
    )


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            diff = compare(query(spark, sf_dir), con, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            diff = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(diff)
        print(f"{'ok ' if not diff else 'BAD'} {name} {time.time() - started:.1f}s {diff}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
