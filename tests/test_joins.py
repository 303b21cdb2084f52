import pytest
from pyspark.sql import functions as F

from lakepipe.operators.joins import fits_broadcast, hot_keys, lookup_join, salted_join


@pytest.fixture
def skewed(spark):
    """Key 1 holds a third of the rows; key 9 and NULL have no partner."""
    keys = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 10)
    left = spark.range(900).select(F.col("id").alias("row"), keys.cast("int").alias("k"))
    right = spark.range(9).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_join(spark, no_broadcast, skewed, rows, how):
    left, right = skewed
    salted = salted_join(left, right, ["k"], ["row"], how, share=0.05, floor=10)
    plain = left.join(right, "k", how)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_hot_key_is_cut_into_pieces(spark, skewed):
    left, _ = skewed
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = {r["k"]: r["_pieces"] for r in hot_keys(counts, ["k"], "n", share=0.1, floor=10).collect()}
    n = left.filter("k = 1").count()
    assert hot[1] == -(-n // 90)
    assert len(hot) <= 10


def test_small_tables_have_no_hot_keys(spark, skewed):
    left, _ = skewed
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert hot_keys(counts, ["k"], "n").count() == 0


def test_known_counts_give_the_same_result(spark, skewed, rows):
    left, right = skewed
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    with_counts = salted_join(left, right, ["k"], ["row"], counts=(counts, "n"), share=0.05, floor=10)
    assert rows(with_counts) == rows(left.join(right, "k"))


def test_full_outer_join_cannot_be_salted(spark, skewed):
    with pytest.raises(ValueError):
        salted_join(*skewed, ["k"], ["row"], "full_outer")


def test_lookup_join_broadcasts_only_below_the_limit(spark, skewed, plan_text, rows):
    left, right = skewed
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert fits_broadcast(right)
    small = lookup_join(left, right, ["k"], ["row"])
    assert "_piece" not in plan_text(small)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        assert not fits_broadcast(right)
        large = lookup_join(left, right, ["k"], ["row"])
        assert "_piece" in plan_text(large)
        assert rows(large) == rows(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
