import datetime as dt
import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from lakepipe.functions.keys import (
    DRAW_FACTOR,
    DRAW_MODULUS,
    bucket_of,
    date_key,
    hash_unit,
    jump_bucket,
    row_key,
    row_token,
)
from lakepipe.functions.money import exact_avg, exact_sum, rate
from lakepipe.functions.risk import flag_above, risk_bucket
from lakepipe.functions.times import source_timestamp


def test_exact_sum_does_not_depend_on_the_order(spark):
    amounts = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9, 12.34, 0.05] * 50
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    sums = {df.repartition(n).agg(exact_sum("a")).first()[0] for n in (1, 2, 3, 7)}
    assert sums == {round(sum(int(round(a * 100)) for a in amounts) / 100, 2)}


def test_sum_and_average_of_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert tuple(df.agg(exact_sum("a"), exact_avg("a")).first()) == (None, None)
    some = spark.createDataFrame([(1.5,), (None,), (2.5,)], "a double")
    assert tuple(some.agg(exact_sum("a"), exact_avg("a")).first()) == (4.0, 2.0)


def test_rate_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 8000), (0, 0), (None, 2)], "p int, w int")
    assert [r[0] for r in df.select(rate("p", "w")).collect()] == [0.3333, 0.0001, None, None]


def test_date_key(spark):
    df = spark.sql("SELECT DATE '2020-02-29' AS d")
    assert df.select(date_key("d")).first()[0] == 20200229


def test_row_token_is_xxhash64(spark):
    value = spark.range(7, 8).select(F.xxhash64("id")).first()[0]
    expected = xxhash.xxh64((7).to_bytes(8, "little", signed=True), seed=42).intdigest()
    assert value % 2**64 == expected


def test_row_keys_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, 1.0), (None, None)], "a double, b double")
    assert df.select(row_key("a", "b")).distinct().count() == 4
    assert df.select(row_token("a", "b")).distinct().count() == 4
    assert all(len(r[0]) == 32 for r in df.select(row_key("a", "b")).collect())


def test_row_keys_do_not_depend_on_the_partitioning(spark, rows):
    df = spark.range(200).select("id", (F.col("id") % 7).alias("v"))
    keyed = [rows(df.repartition(n).select("id", row_key("id", "v"))) for n in (1, 2, 7)]
    assert keyed[0] == keyed[1] == keyed[2]


def test_hash_unit_can_be_repeated_outside_spark(spark):
    got = {r[0]: r[1] for r in spark.range(50).select("id", hash_unit("id", 7)).collect()}
    for key, unit in got.items():
        digest = hashlib.md5(f"7:{key}".encode()).hexdigest()
        assert unit == int(digest[:8], 16) / 2**32
    assert all(0 <= u < 1 for u in got.values())


def test_bucket_of_negative_tokens(spark):
    df = spark.createDataFrame([(-7,), (7,)], "t bigint")
    assert [r[0] for r in df.select(bucket_of(F.col("t"), 5)).collect()] == [3, 2]


def test_source_timestamp(spark):
    df = spark.createDataFrame([(0.0,), (86399.5,), (172792.0,)], "t double")
    got = [r[0] for r in df.select(source_timestamp("t")).collect()]
    start = dt.datetime(2023, 1, 1)
    assert got == [start + dt.timedelta(seconds=s) for s in (0, 86399.5, 172792)]


@pytest.mark.parametrize("score,bucket", [(0.4, "Low"), (0.41, "Medium"), (0.7, "Medium"), (0.71, "High"), (0.0, "Low")])
def test_risk_limits_are_exclusive(spark, score, bucket):
    assert spark.range(1).select(risk_bucket(F.lit(score))).first()[0] == bucket


def test_flag_on_the_threshold(spark):
    row = spark.range(1).select(flag_above(F.lit(0.5), 0.5), flag_above(F.lit(0.5), 0.5, inclusive=True)).first()
    assert tuple(row) == (0, 1)


def jump_by_hand(token, count):
    drawn, at, following = token % (DRAW_MODULUS - 1) + 1, -1, 0
    while following < count:
        drawn = drawn * DRAW_FACTOR % DRAW_MODULUS
        at, following = following, int((following + 1) / (drawn / DRAW_MODULUS))
    return at


def test_jump_bucket(spark):
    tokens = [0, 1, -1, 2**63 - 1, -(2**63), DRAW_MODULUS, *range(10**15, 10**15 + 200)]
    df = spark.createDataFrame([(t,) for t in tokens], "t bigint")
    for count in (1, 2, 7, 1000, 10**12):
        got = df.select("t", jump_bucket(F.col("t"), count).alias("b")).collect()
        assert all(r["b"] == jump_by_hand(r["t"], count) for r in got)
        assert all(0 <= r["b"] < count for r in got)
    assert df.select(jump_bucket(F.col("t"), 0).alias("b")).filter("b IS NOT NULL").count() == 0
    assert spark.range(1).select(jump_bucket(F.lit(None).cast("bigint"), 5)).first()[0] is None


def test_jump_buckets_are_even_and_grow_by_their_share(spark):
    keys = spark.range(60_000).select(F.xxhash64("id").alias("t"))
    dealt = keys.select(jump_bucket(F.col("t"), 20).alias("a"), jump_bucket(F.col("t"), 21).alias("b")).cache()
    sizes = [r["count"] for r in dealt.groupBy("a").count().collect()]
    assert len(sizes) == 20 and sum((s - 3000) ** 2 / 3000 for s in sizes) < 50
    moved = dealt.filter("a <> b")
    assert moved.filter("b <> 20").count() == 0
    assert 0.9 * 60_000 / 21 < moved.count() < 1.1 * 60_000 / 21
    dealt.unpersist()
