"""Gold marts and the analyst reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.functions.money import exact_avg, exact_sum, rate


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        exact_sum("amount").alias("total_amount"),
        F.sum("fraud_flag").alias("fraud_count"),
    ]


def daily_summary(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Transactions, amount and fraud per calendar day."""
    days = calendar.select("date_sk", "full_date")
    grouped = fact.join(days, "date_sk").groupBy("date_sk", "full_date").agg(*_measures())
    return grouped.withColumn("fraud_rate", rate("fraud_count", "total_transactions"))


def monthly_summary(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    months = calendar.select("date_sk", "year", "month")
    grouped = fact.join(months, "date_sk").groupBy("year", "month").agg(*_measures())
    return grouped.withColumn("fraud_rate", rate("fraud_count", "total_transactions"))


def fraud_rate_by_day(daily: DataFrame) -> DataFrame:
    """A view of the daily mart: the fact table is not read again."""
    return daily.select("date_sk", "full_date", "fraud_count", "total_transactions", "fraud_rate")


def customer_activity(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Spending and fraud per customer of the dimension (unique on customer_sk).

    The fact table is reduced to one row per customer before the join, so the join moves one row
    per customer and a customer with very many transactions is combined on the map side.
    """
    grouped = fact.groupBy("customer_sk").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        exact_sum("amount").alias("total_spent"),
        exact_avg("amount").alias("avg_transaction_amount"),
        F.sum("fraud_flag").alias("fraud_count"),
    )
    known = grouped.join(customers.select("customer_sk"), "customer_sk")
    return known.withColumn("fraud_rate", rate("fraud_count", "transaction_count"))


def daily_revenue(daily: DataFrame) -> DataFrame:
    query = """
        SELECT full_date AS transaction_date, SUM(total_amount) AS daily_revenue
        FROM {daily} GROUP BY full_date ORDER BY transaction_date
    """
    return daily.sparkSession.sql(query, daily=daily)


def top_customers(fact: DataFrame, n: int = 10) -> DataFrame:
    """The customers with the highest spending; equal ones by key."""
    spent = fact.groupBy("customer_sk").agg(exact_sum("amount").alias("total_spent"))
    query = "SELECT customer_sk, total_spent FROM {spent} ORDER BY total_spent DESC, customer_sk LIMIT {n}"
    return fact.sparkSession.sql(query, spent=spent, n=n)


def monthly_trend(monthly: DataFrame) -> DataFrame:
    """Revenue per month of the year, all years together."""
    query = "SELECT month, SUM(total_amount) AS monthly_revenue FROM {monthly} GROUP BY month ORDER BY month"
    return monthly.sparkSession.sql(query, monthly=monthly)


def fraud_monitor(fraud_rate: DataFrame) -> DataFrame:
    query = "SELECT full_date AS transaction_date, fraud_rate FROM {fraud_rate} ORDER BY transaction_date"
    return fraud_rate.sparkSession.sql(query, fraud_rate=fraud_rate)
