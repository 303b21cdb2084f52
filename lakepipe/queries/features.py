"""Feature tables and training sets over the events."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lakepipe.plans import features, training
from lakepipe.plans.models import assemble
from lakepipe.queries import views
from lakepipe.queries.views import EVENT_FACT_SQL, money


def _inputs(spark, sf_dir):
    return views.event_fact(spark, sf_dir), views.event_calendar(spark, sf_dir)


def customer_lifetime(spark, sf_dir):
    return features.lifetime(views.event_fact(spark, sf_dir))


def recency(spark, sf_dir):
    return features.recency(*_inputs(spark, sf_dir))


def rolling_7d(spark, sf_dir):
    return features.rolling_7d(*_inputs(spark, sf_dir))


def rolling_7d_asof(spark, sf_dir):
    return features.rolling_7d(*_inputs(spark, sf_dir), leak_free=True)


def training_v1(spark, sf_dir):
    """Joined from the three feature tables."""
    fact, calendar = _inputs(spark, sf_dir)
    return training.join_features(
        fact, features.rolling_7d(fact, calendar), features.recency(fact, calendar), features.lifetime(fact)
    )


def training_direct(spark, sf_dir):
    """The same table with the fact table moved once."""
    return views.event_training(spark, sf_dir)


def training_asof(spark, sf_dir):
    """Every feature from earlier days only."""
    return training.training_set(*_inputs(spark, sf_dir), leak_free=True)


def features_v2(spark, sf_dir):
    """Ratios and products are compared to the last digit; logarithms differ there between libraries."""
    derived = training.add_derived_features(views.event_training(spark, sf_dir))
    columns = [
        F.round(c, 6).alias(c) if c.startswith("log_") else F.col(c) for c in training.DERIVED_FEATURES
    ]
    return derived.select("transaction_sk", *columns)


def feature_vector(spark, sf_dir):
    """The assembled vector, taken apart again."""
    vectors = assemble(views.event_training(spark, sf_dir), training.BASE_FEATURES)
    values = vectors.select("transaction_sk", vector_to_array("features").alias("v"))
    return values.select("transaction_sk", *[F.col("v")[i].alias(c) for i, c in enumerate(training.BASE_FEATURES)])


QUERIES = {
    "q_customer_lifetime": customer_lifetime,
    "q_recency": recency,
    "q_rolling_7d": rolling_7d,
    "q_rolling_7d_asof": rolling_7d_asof,
    "q_training_v1": training_v1,
    "q_training_direct": training_direct,
    "q_training_asof": training_asof,
    "q_features_v2": features_v2,
    "q_feature_vector": feature_vector,
}

LIFETIME_SQL = f"""
    SELECT customer_sk, COUNT(*) AS total_transactions, {money("amount")} AS total_spent,
        {money("amount")} / COUNT(amount) AS avg_transaction_amount,
        CAST(SUM(fraud_flag) AS BIGINT) AS total_fraud_count, ROUND(SUM(fraud_flag) / COUNT(*), 4) AS fraud_ratio
    FROM ({EVENT_FACT_SQL}) GROUP BY customer_sk
"""


def _rolling_sql(end: str) -> str:
    frame = f"(PARTITION BY customer_sk ORDER BY full_date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND {end})"
    return f"""
        SELECT transaction_sk, customer_sk, COUNT(*) OVER w AS transactions_last_7d,
            CAST(SUM(CAST(amount AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total_spent_last_7d,
            CAST(SUM(fraud_flag) OVER w AS BIGINT) AS fraud_count_last_7d,
            ROUND(SUM(fraud_flag) OVER w / NULLIF(COUNT(*) OVER w, 0), 4) AS fraud_ratio_last_7d
        FROM ({EVENT_FACT_SQL}) WINDOW w AS {frame}
    """


ROLLING_SQL, ROLLING_ASOF_SQL = _rolling_sql("CURRENT ROW"), _rolling_sql("INTERVAL 1 DAY PRECEDING")

RECENCY_SQL = f"""
    SELECT transaction_sk, customer_sk, CAST(date_diff('day', lag(full_date) OVER w, full_date) AS DOUBLE)
        AS days_since_last_txn
    FROM ({EVENT_FACT_SQL}) WINDOW w AS (PARTITION BY customer_sk ORDER BY full_date, transaction_sk)
"""

TRAINING_SQL = f"""
    SELECT transaction_sk, customer_sk, amount, transactions_last_7d, total_spent_last_7d, fraud_count_last_7d,
        fraud_ratio_last_7d, days_since_last_txn, total_transactions, total_spent, avg_transaction_amount,
        total_fraud_count, fraud_ratio, fraud_flag
    FROM ({EVENT_FACT_SQL})
        JOIN (SELECT * EXCLUDE (customer_sk) FROM ({ROLLING_SQL})) USING (transaction_sk)
        JOIN (SELECT * EXCLUDE (customer_sk) FROM ({RECENCY_SQL})) USING (transaction_sk)
        JOIN ({LIFETIME_SQL}) USING (customer_sk)
"""

ORACLE = {
    "q_customer_lifetime": LIFETIME_SQL,
    "q_recency": RECENCY_SQL,
    "q_rolling_7d": ROLLING_SQL,
    "q_rolling_7d_asof": ROLLING_ASOF_SQL,
    "q_training_v1": TRAINING_SQL,
    "q_training_direct": TRAINING_SQL,
    "q_training_asof": f"""
        SELECT transaction_sk, customer_sk, amount, transactions_last_7d, total_spent_last_7d, fraud_count_last_7d,
            fraud_ratio_last_7d, days_since_last_txn, COUNT(*) OVER w AS total_transactions,
            CAST(SUM(CAST(amount AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total_spent,
            CAST(SUM(CAST(amount AS DECIMAL(18,2))) OVER w AS DOUBLE) / NULLIF(COUNT(amount) OVER w, 0)
                AS avg_transaction_amount,
            CAST(SUM(fraud_flag) OVER w AS BIGINT) AS total_fraud_count,
            ROUND(SUM(fraud_flag) OVER w / NULLIF(COUNT(*) OVER w, 0), 4) AS fraud_ratio, fraud_flag
        FROM ({EVENT_FACT_SQL})
            JOIN (SELECT * EXCLUDE (customer_sk) FROM ({ROLLING_ASOF_SQL})) USING (transaction_sk)
            JOIN (SELECT * EXCLUDE (customer_sk) FROM ({RECENCY_SQL})) USING (transaction_sk)
        WINDOW w AS (PARTITION BY customer_sk ORDER BY full_date
            RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)
    """,
    "q_features_v2": f"""
        SELECT transaction_sk,
            CASE WHEN avg_transaction_amount > 0 THEN amount / avg_transaction_amount ELSE 0 END AS amount_vs_avg,
            COALESCE(amount / (total_spent_last_7d / transactions_last_7d), 0) AS amount_vs_7d_avg,
            ROUND(ln(1 + amount), 6) AS log_amount, ROUND(ln(1 + total_spent), 6) AS log_total_spent,
            ROUND(ln(1 + total_transactions), 6) AS log_total_transactions,
            amount * fraud_ratio AS amount_x_fraud_ratio,
            transactions_last_7d * fraud_ratio_last_7d AS velocity_x_fraud_ratio
        FROM ({TRAINING_SQL})
    """,
    "q_feature_vector": "SELECT transaction_sk, "
    + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0) AS {c}" for c in training.BASE_FEATURES)
    + f" FROM ({TRAINING_SQL})",
}
