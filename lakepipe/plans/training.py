"""Training sets for the fraud model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.operators.joins import lookup_join
from lakepipe.plans.features import LIFETIME, ROLLING, transaction_features

# The model inputs in the order of the feature vector.
BASE_FEATURES = ["amount", *ROLLING, "days_since_last_txn", *LIFETIME]
DERIVED_FEATURES = [
    "amount_vs_avg",
    "amount_vs_7d_avg",
    "log_amount",
    "log_total_spent",
    "log_total_transactions",
    "amount_x_fraud_ratio",
    "velocity_x_fraud_ratio",
]
ALL_FEATURES = [*BASE_FEATURES, *DERIVED_FEATURES]
LABEL = "fraud_flag"
TRAINING_COLUMNS = ["transaction_sk", "customer_sk", *BASE_FEATURES, LABEL]


def join_features(
    fact: DataFrame, rolling: DataFrame, recent: DataFrame, life: DataFrame
) -> DataFrame:
    """Training set from three stored feature tables.

    Two joins are on the unique transaction key; the one on the customer is spread over tasks for
    customers with very many rows, whose counts the lifetime table already has.
    """
    base = fact.select("transaction_sk", "customer_sk", "amount", LABEL)
    joined = base.join(rolling.drop("customer_sk"), "transaction_sk").join(
        recent.drop("customer_sk"), "transaction_sk"
    )
    counts = (life.select("customer_sk", "total_transactions"), "total_transactions")
    joined = lookup_join(joined, life, ["customer_sk"], spread=["transaction_sk"], counts=counts)
    return joined.select(*TRAINING_COLUMNS)


def training_set(fact: DataFrame, calendar: DataFrame, leak_free: bool = False) -> DataFrame:
    """The same training set straight from the fact table, which moves only once."""
    return transaction_features(fact, calendar, leak_free).select(*TRAINING_COLUMNS)


def add_derived_features(df: DataFrame) -> DataFrame:
    """Ratios to the customer's averages, logarithms and interactions.

    amount_vs_avg is 0 where the average is not positive; amount_vs_7d_avg is 0 where it has no
    value; a logarithm is NULL for amounts of -1 and less.
    """
    average = F.col("avg_transaction_amount")
    week_average = F.try_divide("total_spent_last_7d", "transactions_last_7d")
    derived = df.withColumns(
        {
            "amount_vs_avg": F.when(average > 0, F.try_divide("amount", average)).otherwise(F.lit(0.0)),
            "amount_vs_7d_avg": F.try_divide(F.col("amount"), week_average),
            "log_amount": F.log1p("amount"),
            "log_total_spent": F.log1p("total_spent"),
            "log_total_transactions": F.log1p("total_transactions"),
            "amount_x_fraud_ratio": F.col("amount") * F.col("fraud_ratio"),
            "velocity_x_fraud_ratio": F.col("transactions_last_7d") * F.col("fraud_ratio_last_7d"),
        }
    )
    return derived.fillna(0, ["amount_vs_7d_avg"])


def fill_missing(df: DataFrame, columns: Sequence[str], mark_first: bool = False) -> DataFrame:
    """Zero for missing features. `mark_first` keeps apart a customer's first transaction and one
    on the same day as the last, in a column `is_first_txn`."""
    if mark_first:
        df = df.withColumn("is_first_txn", F.col("days_since_last_txn").isNull().cast("int"))
    return df.fillna(0, subset=list(columns))
