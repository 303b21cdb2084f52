"""Small state tables: high marks of incremental loads and the registry of training runs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.sources.readers import read_or_empty

MARK_SCHEMA = "source string, high_mark string, committed_at timestamp"
BATCH_SCHEMA = "source string, batch_id string, state string, noted_at timestamp"
COUNT_SCHEMA = "batch_id string, customer_count bigint, noted_at timestamp"
REGISTRY_SCHEMA = "run_id string, kind string, name string, text string, number double"


def high_marks(spark: SparkSession, path: str) -> DataFrame:
    """The highest mark per source (ISO dates, so text order is date order)."""
    return read_or_empty(spark, path, MARK_SCHEMA).groupBy("source").agg(F.max("high_mark").alias("high_mark"))


def read_high_mark(spark: SparkSession, path: str, source: str) -> str | None:
    row = high_marks(spark, path).filter(F.col("source") == source).first()
    return row["high_mark"] if row else None


def advance_high_mark(loaded: DataFrame, column: str, path: str, source: str) -> None:
    """Add the highest `column` of the loaded rows as the source's mark; call it after the data is written."""
    mark = loaded.selectExpr(f"cast(max({column}) as string) as high_mark").filter("high_mark is not null")
    row = mark.select(F.lit(source).alias("source"), "high_mark", F.current_timestamp().alias("committed_at"))
    row.coalesce(1).write.mode("append").parquet(path)


def note_batch(spark: SparkSession, path: str, source: str, batch_id: str, state: str) -> None:
    """Note that a batch is "ingested" or "loaded"."""
    row = spark.range(1).select(
        F.lit(source).alias("source"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(state).alias("state"),
        F.current_timestamp().alias("noted_at"),
    )
    row.coalesce(1).write.mode("append").parquet(path)


def pending_batches(spark: SparkSession, path: str, source: str) -> list[str]:
    """Batches that were ingested and not loaded since, the oldest first."""
    noted = read_or_empty(spark, path, BATCH_SCHEMA).filter(F.col("source") == source)
    last = noted.groupBy("batch_id").agg(
        F.max(F.when(F.col("state") == "ingested", F.col("noted_at"))).alias("ingested"),
        F.max(F.when(F.col("state") == "loaded", F.col("noted_at"))).alias("loaded"),
    )
    waiting = last.filter("ingested IS NOT NULL AND (loaded IS NULL OR loaded < ingested)")
    return [r["batch_id"] for r in waiting.orderBy("ingested", "batch_id").collect()]


def noted_batches(spark: SparkSession, path: str, source: str, state: str) -> set[str]:
    """Batches that were ever noted with a state."""
    noted = read_or_empty(spark, path, BATCH_SCHEMA).filter((F.col("source") == source) & (F.col("state") == state))
    return {r["batch_id"] for r in noted.select("batch_id").distinct().collect()}


def first_loads(spark: SparkSession, path: str, source: str) -> DataFrame:
    """(batch_id, first_loaded): when each batch was loaded for the first time."""
    loaded = read_or_empty(spark, path, BATCH_SCHEMA).filter((F.col("source") == source) & (F.col("state") == "loaded"))
    return loaded.groupBy("batch_id").agg(F.min("noted_at").alias("first_loaded"))


def customer_counts(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, customer_count): among how many customers each batch's transactions are dealt out."""
    noted = read_or_empty(spark, path, COUNT_SCHEMA)
    return noted.groupBy("batch_id").agg(F.min_by("customer_count", "noted_at").alias("customer_count"))


def customer_count_of(spark: SparkSession, path: str, batch_id: str, customers: DataFrame) -> int:
    """The number of customers when the batch was loaded first; now, and noted, if it never was."""
    noted = customer_counts(spark, path).filter(F.col("batch_id") == batch_id).first()
    if noted is not None:
        return noted["customer_count"]
    count = customers.count()
    row = spark.range(1).select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(count).cast("bigint").alias("customer_count"),
        F.current_timestamp().alias("noted_at"),
    )
    row.coalesce(1).write.mode("append").parquet(path)
    return count


def record_run(spark: SparkSession, path: str, run_id: str, entries: Mapping[str, Mapping[str, Any]]) -> None:
    """Append {kind: {name: value}} of one run; numbers go to `number`, everything also to `text`."""
    rows = []
    for kind, values in entries.items():
        for name, value in values.items():
            number = float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
            text = value.isoformat() if isinstance(value, dt.datetime) else str(value)
            rows.append((run_id, kind, name, text, number))
    spark.createDataFrame(rows, REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, REGISTRY_SCHEMA)


def run_values(spark: SparkSession, path: str, run_id: str, kind: str) -> dict[str, float | str]:
    """{name: value} of one kind of one run."""
    rows = read_runs(spark, path).filter((F.col("run_id") == run_id) & (F.col("kind") == kind)).collect()
    return {r["name"]: r["text"] if r["number"] is None else r["number"] for r in rows}
