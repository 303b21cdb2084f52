import datetime as dt

import pytest

from lakepipe.operators.history import merge_history
from lakepipe.operators.quality import (
    AllowedValues,
    HasSchema,
    NotEmpty,
    NotNull,
    QualityError,
    UniqueKey,
    availability_report,
    orphans,
    quality_report,
    require_clean,
)
from lakepipe.plans import marts
from lakepipe.plans.dimensions import customer_dimension, date_dimension
from lakepipe.plans.facts import build_fact, version_lists


def test_calendar(spark):
    calendar = date_dimension(spark, "2020-01-01", "2026-12-31")
    assert calendar.count() == 2557
    by_key = {r["date_sk"]: r for r in calendar.collect()}
    leap = by_key[20200229]
    assert (leap["full_date"], leap["quarter"], leap["day_of_week"]) == (dt.date(2020, 2, 29), 1, 7)
    assert by_key[20210101]["week_of_year"] == 53
    assert by_key[20240107]["day_of_week"] == 1
    assert min(by_key) == 20200101 and max(by_key) == 20261231


@pytest.fixture
def star(spark):
    transactions = spark.createDataFrame(
        [
            (1, 10, dt.date(2024, 1, 1), 5.0, 1),
            (2, 10, dt.date(2024, 1, 1), 2.5, 0),
            (3, 11, dt.date(2024, 2, 1), 1.0, 0),
            (4, 99, dt.date(2024, 2, 1), 8.0, 0),
            (5, 11, dt.date(2030, 1, 1), 4.0, 1),
        ],
        "transaction_id bigint, customer_id bigint, transaction_date date, amount double, fraud_flag int",
    )
    customers = spark.createDataFrame(
        [(0, 10, 1), (1, 11, 1), (2, 12, 1), (3, 10, 0)], "customer_sk bigint, customer_id bigint, is_current int"
    )
    return transactions, customers, date_dimension(spark, "2020-01-01", "2026-12-31")


def test_fact_keeps_dates_outside_the_calendar_and_drops_unknown_customers(star, rows, plan_text):
    fact = build_fact(*star)
    assert [r[:3] for r in rows(fact)] == [(1, 0, 20240101), (2, 0, 20240101), (3, 1, 20240201), (5, 1, 20300101)]
    # The calendar side is distinct and adds no column, so its join is gone.
    assert "full_date" not in plan_text(fact)
    assert [r["date_sk"] for r in orphans(fact, star[2], "date_sk").collect()] == [20300101]


def test_marts(star, rows):
    transactions, customers, calendar = star
    fact = build_fact(transactions, customers)
    daily = marts.daily_summary(fact, calendar)
    assert rows(daily) == [
        (20240101, dt.date(2024, 1, 1), 2, 7.5, 1, 0.5),
        (20240201, dt.date(2024, 2, 1), 1, 1.0, 0, 0.0),
    ]
    assert rows(marts.monthly_summary(fact, calendar)) == [(2024, 1, 2, 7.5, 1, 0.5), (2024, 2, 1, 1.0, 0, 0.0)]
    assert rows(marts.customer_activity(fact, customers)) == [(0, 2, 7.5, 3.75, 1, 0.5), (1, 2, 5.0, 2.5, 1, 0.5)]
    assert rows(marts.top_customers(fact, 1)) == [(0, 7.5)]
    assert [r["month"] for r in marts.monthly_trend(marts.monthly_summary(fact, calendar)).collect()] == [1, 2]


@pytest.fixture
def dimension(spark):
    first = spark.createDataFrame(
        [(0, "a", 1), (1, "b", None), (2, "c", 3), (3, "d", 4)], "customer_id bigint, name string, score int"
    )
    return customer_dimension(first, "2024-01-01")


def snapshot(spark):
    """0 unchanged, 1 changed from NULL, 2 gone, 3 changed, 4 new."""
    return spark.createDataFrame(
        [(0, "a", 1), (1, "b", 2), (3, "e", 4), (4, "f", None)], "customer_id bigint, name string, score int"
    )


def test_history_merge(spark, dimension, rows):
    merged = merge_history(dimension, snapshot(spark), "customer_id", "customer_sk", "2024-06-01")
    old, new = dt.date(2024, 1, 1), dt.date(2024, 6, 1)
    assert rows(merged) == [
        (0, 0, "a", 1, old, None, 1),
        (1, 1, "b", None, old, new, 0),
        (2, 2, "c", 3, old, new, 0),
        (3, 3, "d", 4, old, new, 0),
        (4, 1, "b", 2, new, None, 1),
        (5, 3, "e", 4, new, None, 1),
        (6, 4, "f", None, new, None, 1),
    ]


def test_history_merge_twice_changes_nothing(spark, dimension, rows):
    once = merge_history(dimension, snapshot(spark), "customer_id", "customer_sk", "2024-06-01")
    twice = merge_history(once, snapshot(spark), "customer_id", "customer_sk", "2024-06-01")
    assert rows(once) == rows(twice)


def test_history_merge_can_keep_missing_customers(spark, dimension):
    merged = merge_history(dimension, snapshot(spark), "customer_id", "customer_sk", "2024-06-01", close_missing=False)
    assert merged.filter("customer_id = 2").first()["is_current"] == 1


def test_quality_rules(spark, rows):
    df = spark.createDataFrame(
        [(1, 1.0, 0), (1, None, 1), (2, 2.0, 2), (3, 3.0, None)], "id bigint, amount double, flag int"
    )
    rules = [
        NotEmpty(),
        HasSchema(df.schema),
        NotNull("amount"),
        AllowedValues("flag", (0, 1)),
        UniqueKey(("id",)),
    ]
    report = {r["rule"]: r["violations"] for r in quality_report(df, "t", rules).collect()}
    assert report == {
        "not_empty": 0,
        "schema": 0,
        "not_null(amount)": 1,
        "allowed_values(flag)": 2,
        "unique(id)": 1,
    }
    lenient = quality_report(df, "t", [AllowedValues("flag", (0, 1), nulls_pass=True)])
    assert lenient.first()["violations"] == 1
    with pytest.raises(QualityError, match="not_null"):
        require_clean(quality_report(df, "t", rules))


def test_availability(spark, tmp_path):
    full, empty = str(tmp_path / "full"), str(tmp_path / "empty")
    spark.range(3).write.parquet(full)
    spark.range(0).write.parquet(empty)
    report = availability_report(spark, {"full": full, "empty": empty, "gone": str(tmp_path / "gone")})
    assert {r["table_name"]: r["violations"] for r in report.collect()} == {"full": 0, "empty": 1, "gone": 1}


def test_quality_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id bigint")
    report = {r["rule"]: r["violations"] for r in quality_report(empty, "t", [NotEmpty(), NotNull("id")]).collect()}
    assert report == {"not_empty": 1, "not_null(id)": 0}


def test_a_transaction_meets_one_row_of_its_customer(spark):
    """A thousand versions each: the join gives as many rows as there are facts."""
    start = dt.date(2000, 1, 1)
    versions = spark.range(3).selectExpr("id AS customer_id", "explode(sequence(0, 999)) AS n").selectExpr(
        "customer_id * 1000 + n AS customer_sk", "customer_id", "date_add(DATE '2000-01-01', n * 3) AS valid_from"
    )
    days = [start - dt.timedelta(5), start, start + dt.timedelta(7), start + dt.timedelta(2997), dt.date(2100, 1, 1), None]
    rows = [(10 * c + i, c, day, 1.0, 0) for c in range(4) for i, day in enumerate(days)]
    schema = "transaction_id bigint, customer_id bigint, transaction_date date, amount double, fraud_flag int"
    transactions = spark.createDataFrame(rows, schema)
    got = {r["transaction_sk"]: r["customer_sk"] for r in build_fact(transactions, versions).collect()}
    want = {10 * c + i: c * 1000 + v for c in range(3) for i, v in enumerate([0, 0, 2, 999, 999, 0])}
    assert got == want
    lists = version_lists(versions)
    assert lists.count() == 3 and lists.filter("size(versions) = 1000").count() == 3


def test_versions_that_start_on_one_day_or_never(spark):
    versions = spark.createDataFrame(
        [(1, 7, None), (2, 7, dt.date(2020, 1, 1)), (3, 7, dt.date(2020, 1, 1)), (4, 7, dt.date(2021, 1, 1))],
        "customer_sk bigint, customer_id bigint, valid_from date",
    )
    days = [dt.date(2019, 1, 1), dt.date(2020, 1, 1), dt.date(2020, 6, 1), dt.date(2022, 1, 1)]
    transactions = spark.createDataFrame(
        [(i, 7, day, 1.0, 0) for i, day in enumerate(days)],
        "transaction_id bigint, customer_id bigint, transaction_date date, amount double, fraud_flag int",
    )
    got = sorted((r["transaction_sk"], r["customer_sk"]) for r in build_fact(transactions, versions).collect())
    assert got == [(0, 1), (1, 3), (2, 3), (3, 4)]
