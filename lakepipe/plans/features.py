"""Behaviour features per transaction and per customer.

All windows run over customer-days, not over transactions. The features only look at dates, so a
day's transactions share them, and one customer has at most one row per calendar day in a window
however many transactions they make. The counts, sums and first key of a customer-day are combined
on the map side; the fact table itself moves once, to pick the features up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from lakepipe.functions.money import exact, exact_avg, exact_sum, rate
from lakepipe.functions.times import day_number
from lakepipe.operators.joins import estimated_bytes, fits_broadcast, lookup_join
from lakepipe.session import checkpoint

DAY_KEY = ["customer_sk", "date_sk"]
ROLLING = ["transactions_last_7d", "total_spent_last_7d", "fraud_count_last_7d", "fraud_ratio_last_7d"]
LIFETIME = ["total_transactions", "total_spent", "avg_transaction_amount", "total_fraud_count", "fraud_ratio"]


def _tie(fact: DataFrame) -> Column:
    """Order among the transactions of one day: the key itself, or its hash when it is a text.

    A 64-bit number keeps the aggregation a hash aggregation; a text minimum would force a sort.
    """
    numeric = isinstance(fact.schema["transaction_sk"].dataType, T.NumericType)
    return F.col("transaction_sk") if numeric else F.xxhash64("transaction_sk")


def customer_days(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per customer and calendar day with transactions; days outside the calendar drop out."""
    days = calendar.select("date_sk", day_number("full_date").alias("_day"))
    grouped = (
        fact.join(days, "date_sk")
        .groupBy(*DAY_KEY, "_day")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count("amount").alias("_amounts"),
            F.sum(exact("amount")).alias("_spent"),
            F.sum("fraud_flag").alias("_fraud"),
            F.min(_tie(fact)).alias("_first"),
        )
    )
    # A table too large to broadcast is read again by the salted join, for its counts.
    return grouped if fits_broadcast(grouped, _size_bound(fact)) else checkpoint(grouped)


def _size_bound(fact: DataFrame) -> int:
    """Bound on the customer-days with their features: no more rows than facts, each at most four times
    as wide. It only decides whether hot keys need salting; broadcasting is left to Spark."""
    return 4 * estimated_bytes(fact)


def _by_customer() -> WindowSpec:
    return Window.partitionBy("customer_sk").orderBy("_day")


def _rolling(from_day: int, to_day: int) -> dict[str, Column]:
    frame = _by_customer().rangeBetween(from_day, to_day)
    count, fraud = F.sum("_n").over(frame), F.sum("_fraud").over(frame)
    return {
        "transactions_last_7d": F.coalesce(count, F.lit(0)),
        "total_spent_last_7d": F.sum("_spent").over(frame).cast("double"),
        "fraud_count_last_7d": fraud,
        "fraud_ratio_last_7d": rate(fraud, count),
    }


def _lifetime(frame: WindowSpec) -> dict[str, Column]:
    count, fraud = F.sum("_n").over(frame), F.sum("_fraud").over(frame)
    spent = F.sum("_spent").over(frame).cast("double")
    return {
        "total_transactions": F.coalesce(count, F.lit(0)),
        "total_spent": spent,
        "avg_transaction_amount": F.try_divide(spent, F.sum("_amounts").over(frame)),
        "total_fraud_count": fraud,
        "fraud_ratio": rate(fraud, count),
    }


def _gap() -> Column:
    """Days since the customer's previous day with transactions."""
    return (F.col("_day") - F.lag("_day").over(_by_customer())).cast("double")


def _recency(fact: DataFrame) -> Column:
    """The first transaction of a day carries the gap; the others follow it on the same day."""
    return F.when(_tie(fact) == F.col("_first"), F.col("_gap")).otherwise(F.lit(0.0))


def _attach(fact: DataFrame, days: DataFrame, columns: list[str]) -> DataFrame:
    """Bring features of a customer-day to its transactions."""
    per_day = days.select(*DAY_KEY, *columns)
    counts = (days.select(*DAY_KEY, "_n"), "_n")
    return lookup_join(
        fact, per_day, DAY_KEY, spread=["transaction_sk"], counts=counts, right_at_most=_size_bound(fact)
    )


def rolling_7d(fact: DataFrame, calendar: DataFrame, leak_free: bool = False) -> DataFrame:
    """Counts, spending and fraud of the last 7 days per transaction.

    The frame reaches from 7 days back to the transaction's own day, both included, so it spans 8
    dates and holds the row's own label. `leak_free` ends it on the day before.
    """
    last = -1 if leak_free else 0
    days = customer_days(fact, calendar).withColumns(_rolling(-7, last))
    keyed = fact.select("transaction_sk", *DAY_KEY)
    return _attach(keyed, days, ROLLING).select("transaction_sk", "customer_sk", *ROLLING)


def recency(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Days since the customer's previous transaction in (date, key) order; NULL for the first."""
    days = customer_days(fact, calendar).withColumn("_gap", _gap())
    keyed = fact.select("transaction_sk", *DAY_KEY)
    joined = _attach(keyed, days, ["_first", "_gap"])
    return joined.select("transaction_sk", "customer_sk", _recency(fact).alias("days_since_last_txn"))


def lifetime(fact: DataFrame) -> DataFrame:
    """Totals per customer over all time."""
    grouped = fact.groupBy("customer_sk").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        exact_sum("amount").alias("total_spent"),
        exact_avg("amount").alias("avg_transaction_amount"),
        F.sum("fraud_flag").alias("total_fraud_count"),
    )
    return grouped.withColumn("fraud_ratio", rate("total_fraud_count", "total_transactions"))


def transaction_features(fact: DataFrame, calendar: DataFrame, leak_free: bool = False) -> DataFrame:
    """Fact rows with all rolling, recency and lifetime features from one aggregation and one join.

    `leak_free` lets every feature see earlier days only. Otherwise the result is that of joining
    the three feature tables, with lifetime totals over the days of the calendar.
    """
    if leak_free:
        all_days = _by_customer().rangeBetween(Window.unboundedPreceding, -1)
        rolling = _rolling(-7, -1)
    else:
        all_days = Window.partitionBy("customer_sk")
        rolling = _rolling(-7, 0)
    days = customer_days(fact, calendar).withColumns({**rolling, "_gap": _gap(), **_lifetime(all_days)})
    joined = _attach(fact, days, ["_first", "_gap", *ROLLING, *LIFETIME])
    return joined.withColumn("days_since_last_txn", _recency(fact)).drop("_first", "_gap")
