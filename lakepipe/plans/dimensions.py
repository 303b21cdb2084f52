"""Calendar and customer dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.functions.keys import date_key
from lakepipe.operators.ordering import dense_ids
from lakepipe.sources.readers import date_range, date_range_of


def calendar_columns(days: DataFrame) -> DataFrame:
    """Date parts of `full_date`: weeks are ISO weeks, day_of_week 1 is Sunday."""
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"),
        F.dayofweek(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
    )


def date_dimension(spark: SparkSession, first: str, last: str) -> DataFrame:
    return calendar_columns(date_range(spark, first, last))


def date_dimension_of(df: DataFrame, column: str) -> DataFrame:
    """A calendar from the earliest to the latest day of a column."""
    return calendar_columns(date_range_of(df, column))


def customer_dimension(customers: DataFrame, as_of: str | None = None) -> DataFrame:
    """First load of the customer dimension: one current version per customer.

    Later loads go through operators.history.merge_history, which keeps the versions.
    """
    start = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    numbered = dense_ids(customers, "customer_id", "customer_sk")
    return numbered.withColumns(
        {"valid_from": start, "valid_to": F.lit(None).cast("date"), "is_current": F.lit(1)}
    ).select("customer_sk", *customers.columns, "valid_from", "valid_to", "is_current")
