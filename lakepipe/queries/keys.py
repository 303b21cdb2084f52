"""Keys, deduplication, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakepipe.functions.keys import DRAW_FACTOR, DRAW_MODULUS, bucket_of, jump_bucket
from lakepipe.operators import sampling
from lakepipe.operators.dedup import keep_first
from lakepipe.operators.evaluation import class_distribution
from lakepipe.operators.ordering import dense_ids, dense_row_ids
from lakepipe.queries import views
from lakepipe.queries.views import EVENT_FACT_SQL, unit


def dedup_deterministic(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return keep_first(lines, keys, [c for c in lines.columns if c not in keys])


def surrogate_key(spark, sf_dir):
    customers = views.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return dense_ids(customers, "c_custkey", "customer_sk")


def row_ids(spark, sf_dir):
    """Ids for rows that repeat thousands of times: the copies of a row form one gap-free span."""
    lines = views.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    numbered = dense_row_ids(lines, "row_id", copies_per_step=1000)
    spans = numbered.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.count(F.lit(1)).alias("copies"), (F.max("row_id") - F.min("row_id") + 1).alias("span")
    )
    return spans


def assign_customer(spark, sf_dir):
    """Every event gets one of the N dense customer ids."""
    count = views.table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    events = views.table(spark, sf_dir, "events")
    return events.select("event_id", bucket_of(F.col("event_id") * 7919, count).alias("customer_id"))


def assign_growth(spark, sf_dir):
    """The customer that every event is dealt to, before and after one customer is added."""
    count = views.table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    token = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 12), 16, 10).cast("bigint")
    counted = views.table(spark, sf_dir, "events").select("event_id", token.alias("token"), count.alias("n"))
    return counted.select(
        "event_id",
        jump_bucket(F.col("token"), F.col("n")).alias("customer_id"),
        jump_bucket(F.col("token"), F.col("n") + 1).alias("grown_customer_id"),
    )


def hash_split(spark, sf_dir):
    train, test = sampling.hash_split(views.event_fact(spark, sf_dir), "transaction_sk")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def split_anti(spark, sf_dir):
    """The hold-out as the rows whose key is not in the training part."""
    fact = views.event_fact(spark, sf_dir)
    train, _ = sampling.hash_split(fact, "transaction_sk")
    return sampling.holdout(fact, train, "transaction_sk")


def subtract(spark, sf_dir):
    """Set difference of whole rows; repeated rows come back once."""
    rows = views.event_fact(spark, sf_dir).select("customer_sk", "date_sk", "fraud_flag")
    return sampling.except_rows(rows, rows.filter("fraud_flag = 1").withColumn("fraud_flag", F.lit(0)))


def stratified_split(spark, sf_dir):
    return sampling.stratified_sample(
        views.event_fact(spark, sf_dir), "transaction_sk", "fraud_flag", {0: 0.8, 1: 0.5}
    )


def downsample_balance(spark, sf_dir):
    """All positives and about one and a half negatives for each."""
    return sampling.downsample_majority(views.event_fact(spark, sf_dir), "transaction_sk", "fraud_flag", 1.5)


def class_counts(spark, sf_dir):
    return class_distribution(views.event_fact(spark, sf_dir), "fraud_flag")


def class_weights(spark, sf_dir):
    weighted = sampling.with_class_weights(views.event_fact(spark, sf_dir), "fraud_flag")
    return weighted.select("transaction_sk", "fraud_flag", "class_weight")


QUERIES = {
    "q_dedup_deterministic": dedup_deterministic,
    "q_surrogate_key": surrogate_key,
    "q_row_ids": row_ids,
    "q_assign_customer": assign_customer,
    "q_assign_growth": assign_growth,
    "q_hash_split": hash_split,
    "q_split_anti": split_anti,
    "q_subtract": subtract,
    "q_stratified_split": stratified_split,
    "q_downsample_balance": downsample_balance,
    "q_class_distribution": class_counts,
    "q_class_weights": class_weights,
}

FACT = f"(SELECT * EXCLUDE (full_date) FROM ({EVENT_FACT_SQL}))"

ORACLE = {
    "q_dedup_deterministic": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
                l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS place
            FROM lineitem) WHERE place = 1
    """,
    "q_surrogate_key": """
        SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS customer_sk FROM customer
    """,
    "q_row_ids": """
        SELECT l_returnflag, l_linestatus, l_linenumber, COUNT(*) AS copies, COUNT(*) AS span
        FROM lineitem GROUP BY 1, 2, 3
    """,
    "q_assign_customer": """
        SELECT event_id, event_id * 7919 % (SELECT COUNT(*) FROM customer) AS customer_id FROM events
    """,
    "q_assign_growth": f"""
        WITH RECURSIVE jumps AS (
            SELECT event_id, grown, n, -1::BIGINT AS place, 0::BIGINT AS following,
                CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 12)) AS BIGINT) % {DRAW_MODULUS - 1} + 1 AS s
            FROM events, (SELECT unnest([0, 1]) AS grown, COUNT(*) + unnest([0, 1]) AS n FROM customer)
            UNION ALL
            SELECT event_id, grown, n, following,
                CAST(floor(least(CAST(following + 1 AS DOUBLE)
                    / (CAST(s * {DRAW_FACTOR} % {DRAW_MODULUS} AS DOUBLE) / {DRAW_MODULUS}::DOUBLE), n)) AS BIGINT),
                s * {DRAW_FACTOR} % {DRAW_MODULUS}
            FROM jumps WHERE following < n)
        SELECT event_id, MAX(place) FILTER (grown = 0) AS customer_id, MAX(place) FILTER (grown = 1) AS grown_customer_id
        FROM jumps GROUP BY event_id
    """,
    "q_hash_split": f"""
        SELECT *, CASE WHEN {unit("transaction_sk")} < 0.8 THEN 'train' ELSE 'test' END AS part FROM {FACT}
    """,
    "q_split_anti": f"SELECT * FROM {FACT} WHERE {unit('transaction_sk')} >= 0.8",
    "q_subtract": f"""
        SELECT customer_sk, date_sk, fraud_flag FROM {FACT}
        EXCEPT SELECT customer_sk, date_sk, 0 FROM {FACT} WHERE fraud_flag = 1
    """,
    "q_stratified_split": f"""
        SELECT * FROM {FACT}
        WHERE {unit("transaction_sk")} < CASE fraud_flag WHEN 0 THEN 0.8 WHEN 1 THEN 0.5 END
    """,
    "q_downsample_balance": f"""
        SELECT * FROM {FACT} WHERE fraud_flag = 1 OR {unit("transaction_sk")} < (
            SELECT least(1.0, COUNT(*) FILTER (fraud_flag = 1) / COUNT(*) FILTER (fraud_flag = 0) * 1.5::DOUBLE)
            FROM {FACT})
    """,
    "q_class_distribution": f"SELECT fraud_flag, COUNT(*) AS count FROM {FACT} GROUP BY fraud_flag",
    "q_class_weights": f"""
        SELECT transaction_sk, fraud_flag, CAST(total AS DOUBLE) / (2.0::DOUBLE * n) AS class_weight
        FROM {FACT} JOIN (SELECT fraud_flag, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total FROM {FACT}
            GROUP BY fraud_flag) USING (fraud_flag)
    """,
}
