"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lakepipe.plans.features import customer_days, rolling_7d
from lakepipe.queries import views

SF_DIR = "/root/testdata/sf0.001"
LAZY = [
    "q_dim_date",
    "q_fact",
    "q_fact_salted",
    "q_gold_daily",
    "q_gold_monthly",
    "q_gold_customer_activity",
    "q_silver_transactions",
    "q_dedup_deterministic",
    "q_surrogate_key",
    "q_assign_customer",
    "q_hash_split",
    "q_class_weights",
    "q_dq_report",
    "q_recency",
    "q_rolling_7d",
    "q_training_v1",
    "q_training_direct",
    "q_features_v2",
    "q_score_curve",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_product(spark, plan_text, name):
    text = plan_text(queries()[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_marts_read_only_what_they_need(spark, plan_text):
    text = plan_text(queries()["q_gold_customer_activity"](spark, SF_DIR))
    schemas = [line.split("ReadSchema: ")[1] for line in text.splitlines() if "ReadSchema" in line]
    assert "struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in schemas
    assert all("o_orderpriority" not in s and "c_name" not in s for s in schemas)


def test_customer_mart_aggregates_before_the_join(spark, plan_text):
    text = plan_text(queries()["q_gold_customer_activity"](spark, SF_DIR))
    lines = text.splitlines()
    first_join = next(i for i, line in enumerate(lines) if "Join" in line)
    first_aggregate = next(i for i, line in enumerate(lines) if "HashAggregate" in line)
    assert first_join < first_aggregate


def test_date_join_moves_no_fact_rows(spark, plan_text):
    """Scan, two broadcast joins and the partial aggregation happen before the only fact shuffle."""
    text = plan_text(queries()["q_gold_daily"](spark, SF_DIR))
    assert text.count("BroadcastHashJoin") == 2
    assert text.count("Exchange hashpartitioning") == 1


def test_daily_windows_see_one_row_per_customer_and_day(spark):
    fact, calendar = views.event_fact(spark, SF_DIR), views.event_calendar(spark, SF_DIR)
    hot = fact.withColumn("customer_sk", F.when(F.col("transaction_sk") % 3 == 0, 1).otherwise(F.col("customer_sk")))
    most = customer_days(hot, calendar).groupBy("customer_sk").count().agg(F.max("count")).first()[0]
    assert most <= calendar.count()
    assert rolling_7d(hot, calendar).count() == fact.count()


def test_features_aggregate_by_hash(spark, plan_text):
    text_keys = views.event_fact(spark, SF_DIR).withColumn("transaction_sk", F.col("transaction_sk").cast("string"))
    text = plan_text(customer_days(text_keys, views.event_calendar(spark, SF_DIR)))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_adaptive_execution_splits_a_skewed_join(spark, no_broadcast):
    """A hot customer below the salting floor is still split by Spark while running."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        from lakepipe.plans.facts import build_fact

        transactions = spark.range(0, 100_000, 1, 8).select(
            F.col("id").alias("transaction_id"),
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("bigint").alias("customer_id"),
            F.lit("2024-01-01").cast("date").alias("transaction_date"),
            F.rand(1).alias("amount"),
            F.lit(0).alias("fraud_flag"),
        )
        customers = spark.range(1000).select(
            F.col("id").alias("customer_id"), F.col("id").alias("customer_sk"), F.lit(1).alias("is_current")
        )
        fact = build_fact(transactions, customers)
        assert len(fact.collect()) == 100_000
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_rules_are_counted_by_the_write(spark, tmp_path):
    """One job writes and counts; it reads the rows once, and an empty table counts as well."""
    from lakepipe.operators.quality import AllowedValues, NotEmpty, NotNull, QualityError, UniqueKey, WatchedRules

    rules = [NotNull("a"), AllowedValues("b", (0, 1)), UniqueKey(("a",))]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def write(rows, rules, name):
        watched = WatchedRules(rows, "t", rules)
        watched.rows.write.parquet(str(tmp_path / name))
        watched.require_clean(spark.read.schema(rows.schema).parquet(str(tmp_path / name)))

    good = spark.range(1000).selectExpr("id AS a", "id % 2 AS b").mapInArrow(counted, "a bigint, b bigint")
    write(good, rules, "good")
    assert seen.value == 1000
    bad = {
        "null": ("if(id = 7, null, id) AS a", "0L AS b", "not_null(a) violated 1 times"),
        "value": ("id AS a", "id % 3 AS b", "allowed_values(b) violated 333 times"),
        "twice": ("id DIV 2 AS a", "0L AS b", "unique(a) violated 500 times"),
    }
    for name, (a, b, message) in bad.items():
        with pytest.raises(QualityError) as raised:
            write(spark.range(1000).selectExpr(a, b), rules, name)
        assert message in str(raised.value)
    nothing = good.filter("a < 0")
    write(nothing, rules, "nothing")
    write(nothing.filter("false"), rules, "known_nothing")
    with pytest.raises(QualityError):
        write(nothing, [NotEmpty()], "empty")
