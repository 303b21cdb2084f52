"""Facts and marts brought up to date from the days that changed.

Whatever changes Silver or the customer dimension first notes the days it touches. A refresh builds
the facts of these days again, their totals and the customer totals of their months, and adds the
marts up from the totals. All of it is made from what the tables now hold and the notes go last, so a
refresh that breaks off is simply done again.

| Table | Partitioned by | Written |
|---|---|---|
| `fact_by_day` | `date_sk` | folders of touched days |
| `day_totals` | no: a row a day | as a whole |
| `customer_month_totals` | `month` | folders of touched months |
| the marts | no | as a whole, from the totals |

Totals keep amounts as decimals, so adding them up gives the numbers of a full build to the last
digit. The days of a note and the folders of a table are at most those of the calendar.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.functions.keys import date_key
from lakepipe.functions.money import exact, rate
from lakepipe.layout import Layout
from lakepipe.plans.facts import FACT_COLUMNS, build_fact
from lakepipe.sources.readers import read_or_empty, read_table
from lakepipe.sources.writers import overwrite, remove, subfolders, write_partitioned

NOTE = "transaction_date date"
FACTS = "transaction_sk string, customer_sk bigint, amount double, fraud_flag int, date_sk int"
_TOTALS = "total_transactions bigint, amounts bigint, exact_amount decimal(38,9), fraud_count bigint"
DAY_TOTALS = f"date_sk int, {_TOTALS}"
CUSTOMER_TOTALS = f"customer_sk bigint, {_TOTALS}, month int"


def note_days(days: DataFrame, layout: Layout, name: str) -> None:
    """Note that the facts of these `transaction_date`s are out of date; a note of the same name is replaced."""
    distinct = days.select(F.col("transaction_date").cast("date")).distinct()
    distinct.coalesce(1).write.mode("overwrite").parquet(f"{layout.touched_days}/{name}")


def note_silver_days(spark: SparkSession, layout: Layout, name: str, since: str | None = None) -> None:
    """Note every day that Silver has transactions of, or those from a day on; folder names tell."""
    folders = subfolders(spark, layout.silver("transactions"))
    days = [f.partition("=")[2] for f in folders if f.startswith("transaction_date=")]
    chosen = [(d,) for d in days if since is None or d >= since]
    note_days(spark.createDataFrame(chosen, "transaction_date string"), layout, name)


def changed_since(dimension: DataFrame, merged: DataFrame, as_of: str) -> tuple[bool, str | None]:
    """Whether a merge of `as_of` moves facts to other versions, and from which day on (None: any day).

    New versions count from the day they start. A customer who is new counts on every day, as the first
    version is open to the past; so does a version that starts before another one.
    """
    highest, latest = dimension.agg(F.max("customer_sk"), F.max("valid_from")).first()
    added = merged if highest is None else merged.filter(F.col("customer_sk") > highest)
    if added.isEmpty():
        return False, None
    newcomers = added.join(dimension.select("customer_id"), "customer_id", "left_anti")
    late = latest is not None and dt.date.fromisoformat(as_of) <= latest
    return True, None if late or not newcomers.isEmpty() else as_of


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        F.count("amount").alias("amounts"),
        F.sum(exact("amount")).cast("decimal(38,9)").alias("exact_amount"),
        F.sum("fraud_flag").cast("bigint").alias("fraud_count"),
    ]


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("total_transactions", "amounts", "exact_amount", "fraud_count")]


def _keys(days: Iterable[dt.date]) -> list[int]:
    return sorted({d.year * 10000 + d.month * 100 + d.day for d in days})


def facts_by_day(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_or_empty(spark, layout.gold("fact_by_day"), FACTS).select(*FACT_COLUMNS)


def refresh(spark: SparkSession, layout: Layout) -> list[dt.date]:
    """Bring the facts of noted days and all marts up to date; returns these days.

    The calendar has to know the days, as for a full build: days that it doesn't know are no part of the
    daily and monthly marts until a refresh after it was extended.
    """
    notes = subfolders(spark, layout.touched_days)
    paths = [f"{layout.touched_days}/{n}" for n in notes]
    noted = spark.read.schema(NOTE).parquet(*paths).distinct().collect() if paths else []
    days = sorted(r["transaction_date"] for r in noted)
    if days:
        _refresh_facts(spark, layout, days)
        _refresh_totals(spark, layout, _keys(days))
    _publish_marts(spark, layout)
    for path in paths:
        remove(spark, path)
    return days


def touched_transactions(spark: SparkSession, layout: Layout, days: list[dt.date]) -> DataFrame:
    """The Silver rows of some days; only their folders are opened."""
    return read_table(spark, layout.silver("transactions")).filter(F.col("transaction_date").isin(days))


def _refresh_facts(spark: SparkSession, layout: Layout, days: list[dt.date]) -> None:
    path = layout.gold("fact_by_day")
    transactions = touched_transactions(spark, layout, days)
    customers = read_table(spark, layout.gold("dim_customer"))
    write_partitioned(build_fact(transactions, customers), path, ["date_sk"], mode="replace")
    # Days without facts left: replacing leaves their folders as they were.
    known = transactions.join(customers.select("customer_id"), "customer_id", "left_semi")
    held = {r["k"] for r in known.select(date_key("transaction_date").alias("k")).distinct().collect()}
    for day in set(_keys(days)) - held:
        remove(spark, f"{path}/date_sk={day}")


def _refresh_totals(spark: SparkSession, layout: Layout, days: list[int]) -> None:
    facts = facts_by_day(spark, layout)
    path = layout.gold("day_totals")
    others = read_or_empty(spark, path, DAY_TOTALS).filter(~F.col("date_sk").isin(days))
    again = facts.filter(F.col("date_sk").isin(days)).groupBy("date_sk").agg(*_measures())
    overwrite(others.unionByName(again).coalesce(1), path)

    months = sorted({d // 100 for d in days})
    month = F.floor(F.col("date_sk") / 100).cast("int")
    path = layout.gold("customer_month_totals")
    totals = facts.filter(month.isin(months)).groupBy("customer_sk", month.alias("month")).agg(*_measures())
    write_partitioned(totals, path, ["month"], mode="replace")
    day_totals = read_table(spark, layout.gold("day_totals"))
    held = {r["month"] for r in day_totals.select(month.alias("month")).distinct().collect()}
    for gone in set(months) - held:
        remove(spark, f"{path}/month={gone}")


def _summary(totals: DataFrame, *by: str) -> DataFrame:
    return totals.select(
        *by,
        "total_transactions",
        F.col("exact_amount").cast("double").alias("total_amount"),
        "fraud_count",
        rate("fraud_count", "total_transactions").alias("fraud_rate"),
    )


def daily_summary(day_totals: DataFrame, calendar: DataFrame) -> DataFrame:
    return _summary(day_totals.join(calendar.select("date_sk", "full_date"), "date_sk"), "date_sk", "full_date")


def monthly_summary(day_totals: DataFrame, calendar: DataFrame) -> DataFrame:
    known = day_totals.join(calendar.select("date_sk", "year", "month"), "date_sk")
    return _summary(known.groupBy("year", "month").agg(*_sums()), "year", "month")


def customer_activity(customer_totals: DataFrame, customers: DataFrame) -> DataFrame:
    """From at most one row per customer and month."""
    life = customer_totals.groupBy("customer_sk").agg(*_sums())
    total = F.col("exact_amount").cast("double")
    return life.join(customers.select("customer_sk"), "customer_sk").select(
        "customer_sk",
        F.col("total_transactions").alias("transaction_count"),
        total.alias("total_spent"),
        F.try_divide(total, "amounts").alias("avg_transaction_amount"),
        "fraud_count",
        rate("fraud_count", "total_transactions").alias("fraud_rate"),
    )


def _publish_marts(spark: SparkSession, layout: Layout) -> None:
    day_totals = read_or_empty(spark, layout.gold("day_totals"), DAY_TOTALS)
    customer_totals = read_or_empty(spark, layout.gold("customer_month_totals"), CUSTOMER_TOTALS)
    calendar = read_table(spark, layout.gold("dim_date"))
    daily = daily_summary(day_totals, calendar)
    overwrite(daily, layout.gold("daily_transaction_summary"))
    overwrite(
        daily.select("date_sk", "full_date", "fraud_count", "total_transactions", "fraud_rate"),
        layout.gold("fraud_rate_by_day"),
    )
    overwrite(monthly_summary(day_totals, calendar), layout.gold("monthly_revenue_summary"))
    activity = customer_activity(customer_totals, read_table(spark, layout.gold("dim_customer")))
    overwrite(activity, layout.gold("customer_activity_summary"))
