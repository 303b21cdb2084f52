import datetime as dt
import math
import random

import pytest

from lakepipe.plans.dimensions import date_dimension
from lakepipe.plans.features import lifetime, recency, rolling_7d
from lakepipe.plans.training import add_derived_features, fill_missing, join_features, training_set

FACT = "transaction_sk bigint, customer_sk bigint, date_sk int, amount double, fraud_flag int"


def key(day):
    return day.year * 10000 + day.month * 100 + day.day


@pytest.fixture
def calendar(spark):
    return date_dimension(spark, "2024-01-01", "2024-03-31")


def random_fact(seed=3, n=400):
    """One customer makes a third of the transactions, most of them on a few days."""
    draw = random.Random(seed)
    rows = []
    for sk in range(n):
        customer = 1 if sk % 3 == 0 else draw.randint(2, 8)
        day = dt.date(2024, 1, 1) + dt.timedelta(days=draw.choice([0, 1, 5, 8, 9, 15, 40, draw.randint(0, 80)]))
        rows.append((sk, customer, key(day), draw.randint(1, 5000) / 100, int(draw.random() < 0.2)))
    return rows


def expected_rolling(fact, first=7, last=0):
    days = {sk: dt.datetime.strptime(str(d), "%Y%m%d").date() for sk, _, d, _, _ in fact}
    result = {}
    for sk, customer, *_ in fact:
        near = [
            (amount, fraud)
            for other, c, _, amount, fraud in fact
            if c == customer and last <= (days[sk] - days[other]).days <= first
        ]
        result[sk] = (len(near), round(sum(a for a, _ in near), 2), sum(f for _, f in near))
    return result


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("leak_free", [False, True])
def test_rolling_equals_brute_force(spark, calendar, request, large, leak_free):
    if large:
        request.getfixturevalue("no_broadcast")
    data = random_fact()
    got = rolling_7d(spark.createDataFrame(data, FACT).repartition(5), calendar, leak_free)
    actual = {
        r["transaction_sk"]: (r["transactions_last_7d"], r["total_spent_last_7d"] or 0, r["fraud_count_last_7d"] or 0)
        for r in got.collect()
    }
    assert actual == expected_rolling(data, 7, 1 if leak_free else 0)


def test_rolling_frame_limits(spark, calendar):
    """Seven days apart is in, eight days is out, the same day is in."""
    data = [(1, 1, 20240101, 1.0, 1), (2, 1, 20240108, 2.0, 0), (3, 1, 20240109, 4.0, 0), (4, 1, 20240109, 8.0, 1)]
    got = {r["transaction_sk"]: r for r in rolling_7d(spark.createDataFrame(data, FACT), calendar).collect()}
    assert got[2]["transactions_last_7d"] == 2
    assert got[3]["transactions_last_7d"] == got[4]["transactions_last_7d"] == 3
    assert got[3]["total_spent_last_7d"] == 14.0
    assert got[3]["fraud_ratio_last_7d"] == 0.3333


@pytest.mark.parametrize("text_key", [False, True])
def test_recency(spark, calendar, text_key):
    data = random_fact()
    df = spark.createDataFrame(data, FACT)
    if text_key:
        df = df.withColumn("transaction_sk", df.transaction_sk.cast("string"))
    got = {int(r["transaction_sk"]): r["days_since_last_txn"] for r in recency(df.repartition(5), calendar).collect()}
    days = {sk: dt.datetime.strptime(str(d), "%Y%m%d").date() for sk, _, d, _, _ in data}
    per_customer = {}
    for sk, customer, *_ in data:
        per_customer.setdefault(customer, []).append(sk)
    for keys in per_customer.values():
        ordered = sorted(keys, key=lambda sk: (days[sk], sk))
        expected = [None] + [float((days[b] - days[a]).days) for a, b in zip(ordered, ordered[1:])]
        if text_key:
            # Which transaction of a day comes first differs; the gaps per day do not.
            assert sorted((days[sk], repr(got[sk])) for sk in ordered) == sorted(
                (days[sk], repr(e)) for sk, e in zip(ordered, expected)
            )
        else:
            assert [got[sk] for sk in ordered] == expected


def test_days_outside_the_calendar_drop_out(spark, calendar):
    data = [(1, 1, 20231231, 1.0, 0), (2, 1, 20240101, 1.0, 0)]
    df = spark.createDataFrame(data, FACT)
    assert [r["transactions_last_7d"] for r in rolling_7d(df, calendar).collect()] == [1]
    assert [r["days_since_last_txn"] for r in recency(df, calendar).collect()] == [None]


@pytest.mark.parametrize("large", [False, True])
def test_training_set_in_one_step_equals_the_joined_one(spark, calendar, rows, request, large):
    if large:
        request.getfixturevalue("no_broadcast")
    fact = spark.createDataFrame(random_fact(), FACT).repartition(3)
    joined = join_features(fact, rolling_7d(fact, calendar), recency(fact, calendar), lifetime(fact))
    assert rows(joined) == rows(training_set(fact, calendar))


def test_leak_free_features_ignore_the_own_day(spark, calendar):
    data = [(1, 1, 20240101, 1.0, 1), (2, 1, 20240101, 2.0, 1), (3, 1, 20240105, 4.0, 0)]
    got = {r["transaction_sk"]: r for r in training_set(spark.createDataFrame(data, FACT), calendar, True).collect()}
    assert (got[1]["total_transactions"], got[1]["total_fraud_count"]) == (0, None)
    assert (got[3]["total_transactions"], got[3]["total_spent"], got[3]["fraud_ratio"]) == (2, 3.0, 1.0)
    assert got[3]["transactions_last_7d"] == 2


def test_derived_features_at_the_edges(spark):
    columns = (
        "transaction_sk int, amount double, avg_transaction_amount double, total_spent_last_7d double, "
        "transactions_last_7d bigint, total_spent double, total_transactions bigint, fraud_ratio double, "
        "fraud_ratio_last_7d double"
    )
    data = [
        (1, 10.0, 5.0, 20.0, 4, 100.0, 10, 0.1, 0.25),
        (2, 10.0, 0.0, 0.0, 4, 0.0, 10, 0.0, 0.0),
        (3, -1.0, None, None, 0, -1.0, 0, None, None),
    ]
    got = {r["transaction_sk"]: r for r in add_derived_features(spark.createDataFrame(data, columns)).collect()}
    assert (got[1]["amount_vs_avg"], got[1]["amount_vs_7d_avg"]) == (2.0, 2.0)
    assert got[1]["log_amount"] == pytest.approx(math.log(11))
    assert (got[1]["amount_x_fraud_ratio"], got[1]["velocity_x_fraud_ratio"]) == (1.0, 1.0)
    assert (got[2]["amount_vs_avg"], got[2]["amount_vs_7d_avg"]) == (0.0, 0.0)
    assert (got[3]["amount_vs_avg"], got[3]["amount_vs_7d_avg"]) == (0.0, 0.0)
    assert (got[3]["log_amount"], got[3]["amount_x_fraud_ratio"]) == (None, None)


def test_first_transaction_can_be_marked(spark):
    df = spark.createDataFrame([(None,), (0.0,)], "days_since_last_txn double")
    got = fill_missing(df, ["days_since_last_txn"], mark_first=True)
    assert sorted(tuple(r) for r in got.collect()) == [(0.0, 0), (0.0, 1)]
