"""The given tables seen as customers, transactions and facts, in Spark and in SQL.

Orders are transactions of customers (status F is the flag). Events are transactions of users with
a time of day (type error is the flag).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.functions.keys import date_key
from lakepipe.plans.bronze import FEATURE_COLUMNS
from lakepipe.plans.dimensions import date_dimension_of
from lakepipe.plans.facts import build_fact
from lakepipe.plans.training import training_set


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flag(column: str, value: str) -> Column:
    return F.when(F.col(column) == value, 1).otherwise(0)


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").alias("amount"),
        flag("o_orderstatus", "F").alias("fraud_flag"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("customer_sk"),
        F.col("c_custkey").alias("customer_id"),
        F.lit(1).alias("is_current"),
    )


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension_of(table(spark, sf_dir, "orders"), "o_orderdate")


def order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact(order_transactions(spark, sf_dir), customers(spark, sf_dir))


ORDER_FACT_SQL = """
    SELECT o_orderkey AS transaction_sk, c_custkey + 1 AS customer_sk, CAST(o_orderdate AS DATE) AS full_date,
        CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk, o_totalprice AS amount,
        CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS fraud_flag
    FROM orders JOIN customer ON o_custkey = c_custkey
"""


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_sk"),
        F.col("user_id").alias("customer_sk"),
        date_key("ts").alias("date_sk"),
        F.col("value").alias("amount"),
        flag("event_type", "error").alias("fraud_flag"),
    )


def event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension_of(table(spark, sf_dir, "events"), "ts")


def event_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_set(event_fact(spark, sf_dir), event_calendar(spark, sf_dir))


EVENT_FACT_SQL = """
    SELECT event_id AS transaction_sk, user_id AS customer_sk, CAST(ts AS DATE) AS full_date,
        CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_sk, value AS amount,
        CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fraud_flag
    FROM events
"""


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a score in (0, 1) that is a fixed function of the value, so many scores tie."""
    score = F.col("value") / (F.col("value") + 100)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_sk"),
        flag("event_type", "error").alias("fraud_flag"),
        score.alias("fraud_probability"),
        F.when(score > 0.5, 1.0).otherwise(0.0).alias("prediction"),
    )


SCORED_SQL = """
    SELECT event_id AS transaction_sk, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fraud_flag,
        value / (value + 100) AS fraud_probability,
        CASE WHEN value / (value + 100) > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM events
"""


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the form of the transaction source: whole seconds, 28 features, amount, class."""
    events = table(spark, sf_dir, "events")
    day_seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    seconds = F.datediff(F.to_date("ts"), F.lit("2023-01-01").cast("date")) * 86400 + day_seconds
    # Two features follow from something else than the user, so rows may differ in one of them alone.
    own = {"V5": F.length("event_type"), "V28": F.col("event_id") % 2}
    features = [
        (F.col("user_id") + i + own.get(c, F.lit(0))).cast("double").alias(c) for i, c in enumerate(FEATURE_COLUMNS, 1)
    ]
    return events.select(
        seconds.cast("double").alias("Time"),
        *features,
        F.col("value").alias("Amount"),
        flag("event_type", "error").alias("Class"),
        F.to_date("ts").alias("ingest_date"),
    )


_OWN_SQL = {"V5": " + length(event_type)", "V28": " + event_id % 2"}
FEATURES_SQL = ", ".join(
    f"CAST(user_id + {i}{_OWN_SQL.get(c, '')} AS DOUBLE) AS {c}" for i, c in enumerate(FEATURE_COLUMNS, 1)
)

# The earliest of the events that are equal in all features, value and flag.
SILVER_SQL = f"""
    SELECT user_id, date_trunc('second', ts) AS transaction_timestamp, CAST(ts AS DATE) AS transaction_date,
        {FEATURES_SQL}, value AS amount, flag AS fraud_flag, CAST(ts AS DATE) AS ingest_date
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_id, length(event_type), event_id % 2, value, flag ORDER BY date_trunc('second', ts)) AS place
        FROM (SELECT *, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS flag FROM events)
    ) WHERE place = 1
"""


def money(column: str) -> str:
    """SQL for an exact sum of a double column with two decimals."""
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def unit(key: str, seed: int = 42) -> str:
    """SQL for functions.keys.hash_unit."""
    digest = f"md5('{seed}:' || CAST({key} AS VARCHAR))"
    return f"(CAST(('0x' || substr({digest}, 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"
