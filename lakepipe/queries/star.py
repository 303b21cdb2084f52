"""Dimensions, facts, marts and analyst reports over the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakepipe.operators.history import merge_history
from lakepipe.operators.joins import salted_join
from lakepipe.operators.quality import orphans
from lakepipe.plans import marts
from lakepipe.plans.dimensions import customer_dimension, date_dimension
from lakepipe.plans.facts import build_fact
from lakepipe.queries import views
from lakepipe.queries.views import ORDER_FACT_SQL, money
from lakepipe.session import scratch_path
from lakepipe.sources.writers import stage


def dim_date(spark, sf_dir):
    return views.order_calendar(spark, sf_dir)


def dim_customer(spark, sf_dir):
    silver = views.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "customer_id")
    return customer_dimension(silver, "2024-01-01")


def scd2_merge(spark, sf_dir):
    """Machinery customers are new, furniture customers are gone, building customers changed."""
    snapshot = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_acctbal", F.col("c_mktsegment").alias("segment")
    )
    first = customer_dimension(snapshot.filter("segment <> 'MACHINERY'"), "2024-01-01")
    before = stage(first, scratch_path(spark, "dim-customer"))
    after = snapshot.filter("segment <> 'FURNITURE'").replace("BUILDING", "CONSTRUCTION", "segment")
    return merge_history(before, after, "customer_id", "customer_sk", "2024-06-01")


def fact(spark, sf_dir):
    calendar = views.order_calendar(spark, sf_dir)
    return build_fact(views.order_transactions(spark, sf_dir), views.customers(spark, sf_dir), calendar)


def _customer_versions(spark, sf_dir):
    """Every third customer changed on 1998-01-01, every fourth ended on 1999-01-01."""
    every = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    first = every.select(
        (F.col("customer_id") * 2).alias("customer_sk"),
        "customer_id",
        F.lit("1996-06-01").cast("date").alias("valid_from"),
        F.when(F.col("customer_id") % 3 == 0, F.lit("1998-01-01"))
        .when(F.col("customer_id") % 4 == 0, F.lit("1999-01-01"))
        .cast("date")
        .alias("valid_to"),
    )
    second = every.filter("customer_id % 3 = 0").select(
        (F.col("customer_id") * 2 + 1).alias("customer_sk"),
        "customer_id",
        F.lit("1998-01-01").cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )
    versions = first.unionByName(second)
    return versions.withColumn("is_current", F.col("valid_to").isNull().cast("int"))


def fact_history(spark, sf_dir):
    """Facts with the version of the customer that was valid on their day."""
    return build_fact(views.order_transactions(spark, sf_dir), _customer_versions(spark, sf_dir))


MANY_VERSIONS = 1000


def fact_many_versions(spark, sf_dir):
    """Every fiftieth customer has a thousand versions, one for every second day; each other customer has three."""
    every = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    many = F.col("customer_id") % 50 == 0
    last = F.when(many, MANY_VERSIONS - 1).otherwise(2)
    numbered = every.withColumn("number", F.explode(F.sequence(F.lit(0), last)))
    days = F.when(many, F.col("number") * 2).otherwise(F.col("number") * 700)
    versions = numbered.select(
        (F.col("customer_id") * MANY_VERSIONS + F.col("number")).alias("customer_sk"),
        "customer_id",
        F.date_add(F.lit("1995-06-01").cast("date"), days.cast("int")).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        (F.col("number") == last).cast("int").alias("is_current"),
    )
    return build_fact(views.order_transactions(spark, sf_dir), versions)


def dim_date_range(spark, sf_dir):
    """A calendar of given days, here from the first to the last urgent order."""
    urgent = views.table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    first, last = urgent.agg(F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    return date_dimension(spark, str(first), str(last))


def fact_salted(spark, sf_dir):
    """The customer join of the fact table with every larger customer cut into pieces."""
    transactions = views.order_transactions(spark, sf_dir)
    dimension = views.customers(spark, sf_dir).drop("is_current")
    joined = salted_join(transactions, dimension, ["customer_id"], ["transaction_id"], floor=5)
    return joined.select(
        F.col("transaction_id").alias("transaction_sk"), "customer_sk", "amount", "fraud_flag"
    )


def orphan_dates(spark, sf_dir):
    """Order days missing from a calendar that ends with the last order of status F."""
    orders = views.table(spark, sf_dir, "orders")
    last = orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").agg(F.max("o_orderdate")).scalar()
    calendar = views.order_calendar(spark, sf_dir).filter(F.col("full_date") < F.to_date(last) - 365)
    missing = orphans(views.order_fact(spark, sf_dir), calendar, "date_sk")
    return missing.groupBy("date_sk").agg(F.count(F.lit(1)).alias("transactions"))


def gold_daily(spark, sf_dir):
    return marts.daily_summary(views.order_fact(spark, sf_dir), views.order_calendar(spark, sf_dir))


def gold_monthly(spark, sf_dir):
    return marts.monthly_summary(views.order_fact(spark, sf_dir), views.order_calendar(spark, sf_dir))


def gold_customer_activity(spark, sf_dir):
    return marts.customer_activity(views.order_fact(spark, sf_dir), views.customers(spark, sf_dir))


def gold_fraud_rate(spark, sf_dir):
    return marts.fraud_rate_by_day(gold_daily(spark, sf_dir))


def sql_daily_revenue(spark, sf_dir):
    return marts.daily_revenue(gold_daily(spark, sf_dir))


def sql_top_customers(spark, sf_dir):
    return marts.top_customers(views.order_fact(spark, sf_dir))


def sql_monthly_trend(spark, sf_dir):
    trend = marts.monthly_trend(gold_monthly(spark, sf_dir))
    return trend.select("month", F.round("monthly_revenue", 2).alias("monthly_revenue"))


def sql_fraud_monitor(spark, sf_dir):
    return marts.fraud_monitor(gold_fraud_rate(spark, sf_dir))


QUERIES = {
    "q_dim_date": dim_date,
    "q_dim_customer": dim_customer,
    "q_scd2_merge": scd2_merge,
    "q_fact": fact,
    "q_fact_history": fact_history,
    "q_fact_many_versions": fact_many_versions,
    "q_dim_date_range": dim_date_range,
    "q_fact_salted": fact_salted,
    "q_orphan_dates": orphan_dates,
    "q_gold_daily": gold_daily,
    "q_gold_monthly": gold_monthly,
    "q_gold_customer_activity": gold_customer_activity,
    "q_gold_fraud_rate": gold_fraud_rate,
    "q_sql_daily_revenue": sql_daily_revenue,
    "q_sql_top_customers": sql_top_customers,
    "q_sql_monthly_trend": sql_monthly_trend,
    "q_sql_fraud_monitor": sql_fraud_monitor,
}

DAILY_SQL = f"""
    SELECT date_sk, full_date, COUNT(*) AS total_transactions, {money("amount")} AS total_amount,
        CAST(SUM(fraud_flag) AS BIGINT) AS fraud_count, ROUND(SUM(fraud_flag) / COUNT(*), 4) AS fraud_rate
    FROM ({ORDER_FACT_SQL}) GROUP BY date_sk, full_date
"""

def _calendar_sql(where: str) -> str:
    return f"""
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, CAST(d AS DATE) AS full_date,
            CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
            CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
            CAST(weekofyear(d) AS INTEGER) AS week_of_year
        FROM (SELECT unnest(generate_series(
            date_trunc('day', MIN(o_orderdate)), date_trunc('day', MAX(o_orderdate)), INTERVAL 1 DAY)) AS d FROM orders {where})
    """


ORACLE = {
    "q_dim_date": _calendar_sql(""),
    "q_dim_date_range": _calendar_sql("WHERE o_orderpriority = '1-URGENT'"),
    "q_fact_history": """
        SELECT o_orderkey AS transaction_sk,
            o_custkey * 2 + CASE WHEN o_custkey % 3 = 0 AND o_orderdate >= DATE '1998-01-01' THEN 1 ELSE 0 END
                AS customer_sk,
            CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk, o_totalprice AS amount,
            CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS fraud_flag
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "q_fact_many_versions": f"""
        SELECT o_orderkey AS transaction_sk,
            CAST(o_custkey * {MANY_VERSIONS} + greatest(0, CASE WHEN o_custkey % 50 = 0
                THEN least({MANY_VERSIONS - 1}, datediff('day', DATE '1995-06-01', CAST(o_orderdate AS DATE)) // 2)
                ELSE least(2, datediff('day', DATE '1995-06-01', CAST(o_orderdate AS DATE)) // 700) END) AS BIGINT)
                AS customer_sk,
            CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_sk, o_totalprice AS amount,
            CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS fraud_flag
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "q_dim_customer": """
        SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS customer_sk, c_custkey AS customer_id, c_name,
            c_nationkey, c_acctbal, c_mktsegment, DATE '2024-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to,
            1 AS is_current
        FROM customer
    """,
    "q_scd2_merge": """
        WITH s AS (SELECT c_custkey AS customer_id, c_acctbal, c_mktsegment AS segment FROM customer),
        first AS (
            SELECT row_number() OVER (ORDER BY customer_id) - 1 AS customer_sk, * FROM s WHERE segment <> 'MACHINERY')
        SELECT customer_sk, customer_id, c_acctbal, segment, DATE '2024-01-01' AS valid_from,
            CASE WHEN segment IN ('FURNITURE', 'BUILDING') THEN DATE '2024-06-01' END AS valid_to,
            CASE WHEN segment IN ('FURNITURE', 'BUILDING') THEN 0 ELSE 1 END AS is_current
        FROM first
        UNION ALL
        SELECT (SELECT COUNT(*) FROM first) + row_number() OVER (ORDER BY customer_id) - 1, customer_id, c_acctbal,
            CASE segment WHEN 'BUILDING' THEN 'CONSTRUCTION' ELSE segment END, DATE '2024-06-01', NULL, 1
        FROM s WHERE segment IN ('MACHINERY', 'BUILDING')
    """,
    "q_fact": f"SELECT transaction_sk, customer_sk, date_sk, amount, fraud_flag FROM ({ORDER_FACT_SQL})",
    "q_fact_salted": f"SELECT transaction_sk, customer_sk, amount, fraud_flag FROM ({ORDER_FACT_SQL})",
    "q_orphan_dates": f"""
        SELECT date_sk, COUNT(*) AS transactions FROM ({ORDER_FACT_SQL})
        WHERE full_date >= (SELECT CAST(MAX(o_orderdate) AS DATE) - 365 FROM orders
            WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
        GROUP BY date_sk
    """,
    "q_gold_daily": DAILY_SQL,
    "q_gold_monthly": f"""
        SELECT CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
            COUNT(*) AS total_transactions, {money("amount")} AS total_amount,
            CAST(SUM(fraud_flag) AS BIGINT) AS fraud_count, ROUND(SUM(fraud_flag) / COUNT(*), 4) AS fraud_rate
        FROM ({ORDER_FACT_SQL}) GROUP BY 1, 2
    """,
    "q_gold_customer_activity": f"""
        SELECT customer_sk, COUNT(*) AS transaction_count, {money("amount")} AS total_spent,
            {money("amount")} / COUNT(amount) AS avg_transaction_amount,
            CAST(SUM(fraud_flag) AS BIGINT) AS fraud_count, ROUND(SUM(fraud_flag) / COUNT(*), 4) AS fraud_rate
        FROM ({ORDER_FACT_SQL}) GROUP BY customer_sk
    """,
    "q_gold_fraud_rate": f"""
        SELECT date_sk, full_date, fraud_count, total_transactions, fraud_rate FROM ({DAILY_SQL})
    """,
    "q_sql_daily_revenue": f"""
        SELECT full_date AS transaction_date, {money("amount")} AS daily_revenue
        FROM ({ORDER_FACT_SQL}) GROUP BY full_date ORDER BY transaction_date
    """,
    "q_sql_top_customers": f"""
        SELECT customer_sk, {money("amount")} AS total_spent
        FROM ({ORDER_FACT_SQL}) GROUP BY customer_sk ORDER BY total_spent DESC, customer_sk LIMIT 10
    """,
    "q_sql_monthly_trend": f"""
        SELECT CAST(month(full_date) AS INTEGER) AS month, {money("amount")} AS monthly_revenue
        FROM ({ORDER_FACT_SQL}) GROUP BY 1 ORDER BY 1
    """,
    "q_sql_fraud_monitor": f"""
        SELECT full_date AS transaction_date, fraud_rate FROM ({DAILY_SQL}) ORDER BY transaction_date
    """,
}
