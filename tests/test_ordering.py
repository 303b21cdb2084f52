import random

import pytest
from pyspark.sql import functions as F

from lakepipe.operators.ordering import dense_ids, dense_row_ids, running_totals, top_share


def numbers(spark, values, partitions=4):
    return spark.createDataFrame([(float(v), i % 5) for i, v in enumerate(values)], "x double, n int").repartition(
        partitions
    )


@pytest.mark.parametrize("blocks", [1, 2, 7, 64])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_a_plain_loop(spark, blocks, descending):
    values = random.Random(1).sample(range(-500, 500), 300)
    df = numbers(spark, values)
    got = {
        r["x"]: r["cum_n"]
        for r in running_totals(df, "x", ["n"], descending=descending, blocks=blocks).collect()
    }
    total, expected = 0, {}
    for x, n in sorted(((float(v), i % 5) for i, v in enumerate(values)), reverse=descending):
        total += n
        expected[x] = total
    assert got == expected


def test_running_totals_of_nothing(spark):
    assert running_totals(numbers(spark, [1.0]).filter("x > 5"), "x", ["n"]).count() == 0


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_dense_ids_do_not_depend_on_the_partitioning(spark, partitions):
    df = spark.createDataFrame([(k * 10,) for k in range(100)], "k bigint").repartition(partitions)
    got = {r["k"]: r["id"] for r in dense_ids(df, "k", "id").collect()}
    assert got == {k * 10: k for k in range(100)}


def test_dense_ids_of_a_text_key(spark):
    df = spark.createDataFrame([(f"name-{k}",) for k in range(100)], "k string")
    first = {r["k"]: r["id"] for r in dense_ids(df, "k", "id", start=5).collect()}
    again = {r["k"]: r["id"] for r in dense_ids(df.repartition(3), "k", "id", start=5).collect()}
    assert sorted(first.values()) == list(range(5, 105))
    assert first == again


def test_dense_row_ids_number_every_copy(spark):
    data = [("a", 1)] * 1000 + [("b", 2)] * 3 + [("c", None), (None, 1), (None, None)]
    df = spark.createDataFrame(data, "k string, `v.w` int").repartition(5)
    numbered = dense_row_ids(df, "id", copies_per_step=100)
    assert sorted(r["id"] for r in numbered.collect()) == list(range(len(data)))
    assert sorted(map(repr, [(r["k"], r["v.w"]) for r in numbered.collect()])) == sorted(map(repr, data))


@pytest.mark.parametrize("share", [0.0, 0.004, 0.05, 0.33, 0.34, 0.5, 1.0])
def test_top_share_cuts_ties_by_key(spark, share):
    # One score holds a third of all rows.
    data = [(i, 0.5 if i % 3 == 0 else (i % 40) / 40) for i in range(300)]
    df = spark.createDataFrame(data, "k bigint, s double").repartition(6)
    expected = sorted(data, key=lambda r: (-r[1], r[0]))[: int(300 * share)]
    got = [tuple(r) for r in top_share(df, "s", "k", share).collect()]
    assert sorted(got) == sorted(expected)


def test_top_share_of_tied_scores(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.lit(0.25).alias("s"))
    assert sorted(r["k"] for r in top_share(df, "s", "k", 0.1).collect()) == list(range(10))
