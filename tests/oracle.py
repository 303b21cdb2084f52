"""Compare queries with their SQL in DuckDB: python tests/oracle.py SF_DIR [--no-broadcast] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    """Numbers by value, so that 1 and 1.0 are alike; everything else as it is."""
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_result(df):
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_result(connection, sql: str):
    cursor = connection.execute(sql)
    return sorted_rows([d[0] for d in cursor.description], cursor.fetchall())


def difference(df, connection, sql: str) -> str | None:
    spark_columns, spark_rows = spark_result(df)
    sql_columns, sql_rows = sql_result(connection, sql)
    if spark_columns != sql_columns:
        return f"columns {spark_columns} / {sql_columns}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    for a, b in zip(spark_rows, sql_rows):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} / {b}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from lakepipe.session import build_session

    sf_dir, wanted = sys.argv[1], [a for a in sys.argv[2:] if not a.startswith("--")]
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    if "--no-broadcast" in sys.argv:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    connection, failed = connect(sf_dir), []
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            sql = oracle_sql().get(name)
            problem = difference(df, connection, sql) if sql else None
            kind = "sql" if sql else f"rows only: {df.count()}"
        except Exception as error:
            problem, kind = f"{type(error).__name__}: {str(error)[:600]}", "error"
        verdict = "ok" if problem is None else f"DIFF {problem}"
        print(f"{name:28} {time.time() - start:6.2f}s {kind:16} {verdict}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    sys.exit(bool(failed))
