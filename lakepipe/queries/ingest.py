"""CSV and Parquet round trips, Silver cleaning, incremental loads in batch and stream form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions.money import exact_sum, rate
from lakepipe.layout import Layout
from lakepipe.plans import marts
from lakepipe.plans.bronze import FEATURE_COLUMNS, rejected
from lakepipe.plans.facts import build_fact
from lakepipe.plans.jobs import Jobs
from lakepipe.plans.silver import transform_customers, transform_transactions
from lakepipe.queries import views
from lakepipe.queries.views import SILVER_SQL, money
from lakepipe.session import scratch_path
from lakepipe.sources.readers import BAD_RECORD, newer_than, read_csv, read_or_empty, read_table
from lakepipe.sources.state import advance_high_mark, high_marks, read_high_mark
from lakepipe.sources.writers import overwrite, stage, write_partitioned
from lakepipe.streaming.incremental import load_distinct, start_incremental_load, start_silver_load

# Where the two-batch loads cut the events.
FIRST_BATCH_END = "2024-01-15"


def csv_roundtrip(spark, sf_dir):
    """Parts as comma-separated and customers as semicolon-separated text, with quotes and both delimiters inside."""
    part = views.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"; '), "p_type").alias("label"),
        F.col("p_retailprice").alias("amount"),
    )
    customer = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.concat("c_name", F.lit('; "'), "c_mktsegment", F.lit('", ')).alias("label"),
        F.col("c_acctbal").alias("amount"),
    )
    schema = T.StructType.fromDDL("id bigint, label string, amount double")
    parts = []
    for name, rows, delimiter in (("part", part, ","), ("customer", customer, ";")):
        path = scratch_path(spark, f"csv-{name}")
        writer = rows.write.option("header", True).option("sep", delimiter).option("quote", '"').option("escape", '"')
        writer.option("ignoreTrailingWhiteSpace", False).csv(path)
        parts.append(read_csv(spark, path, schema, delimiter).select(F.lit(name).alias("source"), *schema.names))
    return parts[0].unionByName(parts[1])


def partitioned_append(spark, sf_dir):
    """Orders appended in two batches to a table partitioned by month."""
    orders = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.trunc("o_orderdate", "month").alias("order_month")
    )
    path = scratch_path(spark, "orders-by-month")
    write_partitioned(orders.filter("o_orderstatus = 'O'"), path, ["order_month"])
    write_partitioned(orders.filter("o_orderstatus <> 'O'"), path, ["order_month"])
    return read_table(spark, path)


def partition_replace(spark, sf_dir):
    """A batch written twice to its own partitions counts once."""
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "orders-by-status")
    write_partitioned(orders, path, ["o_orderstatus"], mode="replace")
    write_partitioned(orders.filter("o_orderstatus = 'F'"), path, ["o_orderstatus"], mode="replace")
    return read_table(spark, path)


def overwrite_roundtrip(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    path = scratch_path(spark, "orders-overwritten")
    overwrite(orders, path)
    overwrite(orders, path)
    return read_table(spark, path)


def _dated_events(spark, sf_dir):
    return views.event_fact(spark, sf_dir).withColumn("ingest_date", F.to_date(F.col("date_sk").cast("string"), "yyyyMMdd"))


def incremental_filter(spark, sf_dir):
    """Events after the stored mark of a first batch; the mark prunes the partitions."""
    events = _dated_events(spark, sf_dir)
    bronze, marks = scratch_path(spark, "bronze-events"), scratch_path(spark, "marks")
    write_partitioned(events, bronze, ["ingest_date"])
    stored = read_table(spark, bronze)
    advance_high_mark(stored.filter(F.col("ingest_date") <= FIRST_BATCH_END), "ingest_date", marks, "events")
    fresh = newer_than(stored, "ingest_date", read_high_mark(spark, marks, "events"))
    return fresh.select("transaction_sk", "customer_sk", "amount", "fraud_flag", "ingest_date")


def incremental_high_mark(spark, sf_dir):
    """The mark after two batches of events and one of orders."""
    marks = scratch_path(spark, "marks")
    events = _dated_events(spark, sf_dir)
    advance_high_mark(events.filter(F.col("ingest_date") <= FIRST_BATCH_END), "ingest_date", marks, "events")
    fresh = newer_than(events, "ingest_date", read_high_mark(spark, marks, "events"))
    advance_high_mark(fresh, "ingest_date", marks, "events")
    advance_high_mark(views.order_transactions(spark, sf_dir), "transaction_date", marks, "orders")
    return high_marks(spark, marks)


def stream_incremental(spark, sf_dir):
    """Daily totals of the events after a streaming load, and after a second run that finds nothing new."""
    schema = views.table(spark, sf_dir, "events").schema
    target, progress = scratch_path(spark, "stream-events"), scratch_path(spark, "stream-progress")

    def clean(batch):
        return batch.select("event_id", "value", F.to_date("ts").alias("event_date"))

    for _ in range(2):
        start_incremental_load(
            spark, f"{sf_dir}/events.parquet*", schema, clean, target, progress
        ).awaitTermination()
    loaded = read_table(spark, target)
    return loaded.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"), exact_sum("value").alias("total")
    )


def silver_customers(spark, sf_dir):
    """Customers with dotted column names and the building segment as the response."""
    raw = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cust.key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acct.bal"),
        F.when(F.col("c_mktsegment") == "BUILDING", "yes").otherwise("no").alias("y"),
    )
    return transform_customers(raw, key="cust_key")


def _customer_count(spark, sf_dir) -> int:
    return views.table(spark, sf_dir, "customer").count()


def _silver(spark, sf_dir):
    draw = F.col("V1").cast("bigint") * 7919
    return transform_transactions(views.raw_transactions(spark, sf_dir), _customer_count(spark, sf_dir), draw)


def silver_transactions(spark, sf_dir):
    return _silver(spark, sf_dir).drop("transaction_id")


def transaction_key(spark, sf_dir):
    """Silver rows and distinct transaction keys: both are the number of distinct business rows."""
    return _silver(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("silver_rows"), F.countDistinct("transaction_id").alias("transaction_keys")
    )


def _lake(spark, sf_dir):
    """Jobs over a new lake whose customers are in Silver already, and a folder for source files."""
    jobs = Jobs(spark, Layout(scratch_path(spark, "lake")))
    overwrite(views.customers(spark, sf_dir), jobs.layout.silver("customers"))
    return jobs, scratch_path(spark, "source")


def _write_source(rows, path):
    """Transactions as the source has them: CSV files with a header."""
    rows.select("Time", *FEATURE_COLUMNS, "Amount", "Class").write.option("header", True).csv(path)
    return path


def _halves(spark, sf_dir):
    raw = views.raw_transactions(spark, sf_dir)
    return raw.filter(F.col("ingest_date") <= FIRST_BATCH_END), raw.filter(F.col("ingest_date") > FIRST_BATCH_END)


def silver_load(spark, sf_dir):
    """The whole incremental job in two batches and an empty third run."""
    jobs, source = _lake(spark, sf_dir)
    for n, part in enumerate(_halves(spark, sf_dir), 1):
        jobs.ingest_transactions(_write_source(part, f"{source}/{n}"), f"2024-02-0{n}")
        jobs.silver_transactions()
    if jobs.silver_transactions() is not None:
        raise ValueError("a load without new batches added rows")
    return _daily(read_table(spark, jobs.layout.silver("transactions")))


def bronze_two_files_one_day(spark, sf_dir):
    """Two sources ingested on one day, before and after a load: both reach Silver."""
    jobs, source = _lake(spark, sf_dir)
    for n, part in enumerate(_halves(spark, sf_dir), 1):
        jobs.ingest_transactions(_write_source(part, f"{source}/{n}"), "2024-02-01")
        jobs.silver_transactions()
    return _daily(read_table(spark, jobs.layout.silver("transactions")))


def silver_repeated_file(spark, sf_dir):
    """The same file on two days, and twice on the second: its rows are in Silver once."""
    jobs, source = _lake(spark, sf_dir)
    path = _write_source(views.raw_transactions(spark, sf_dir), source)
    for day in ("2024-02-01", "2024-02-02", "2024-02-02"):
        jobs.ingest_transactions(path, day)
        jobs.silver_transactions()
    return _daily(read_table(spark, jobs.layout.silver("transactions")))


def csv_bad_records(spark, sf_dir):
    """Rows that parse and rows that don't, after an ingest of a file where every event of user 7 has a bad time."""
    jobs, source = _lake(spark, sf_dir)
    raw = views.raw_transactions(spark, sf_dir)
    bad = F.when(F.col("V1") == 8.0, F.lit("oops")).otherwise(F.col("Time").cast("string"))
    _write_source(raw.withColumn("Time", bad), source)
    jobs.ingest_transactions(source, "2024-02-01")
    target = jobs.layout.bronze("transactions")
    good, wrong = read_table(spark, target), read_table(spark, rejected(target))
    with_text = F.count_if(F.col(BAD_RECORD).startswith("oops,"))
    return good.agg(
        F.count(F.lit(1)).alias("good_rows"), F.count_if(F.col("Time").isNull()).alias("good_without_time")
    ).withColumns({"bad_rows": wrong.agg(F.count(F.lit(1))).scalar(), "bad_with_text": wrong.agg(with_text).scalar()})


# Deliveries of two sources, each a range of user numbers (V1): the first ones, and three corrections.
DELIVERIES = (
    ("a", "V1 <= 100"),
    ("b", "V1 > 50"),
    ("a", "V1 <= 25 OR V1 BETWEEN 60 AND 80"),
    ("a", "V1 <= 10 OR V1 >= 140"),
    ("b", "V1 > 90 AND V1 < 145"),
)
# What Silver holds after each delivery: (owner, condition).
OWNED = (
    (("a", "V1 <= 100"),),
    (("a", "V1 <= 100"), ("b", "V1 > 100")),
    (("a", "V1 <= 25 OR V1 BETWEEN 60 AND 80"), ("b", "V1 > 50 AND V1 NOT BETWEEN 60 AND 80")),
    (("a", "V1 <= 10"), ("b", "V1 > 50")),
    (("a", "V1 <= 10 OR V1 >= 145"), ("b", "V1 > 90 AND V1 < 145")),
)


def _batch_correction(spark, sf_dir, load):
    """Who brought which users' transactions after each delivery, and rejected rows: users 7 and 20 come broken first."""
    jobs, source = _lake(spark, sf_dir)
    raw = views.raw_transactions(spark, sf_dir)
    time = F.col("Time").cast("string")
    broken = raw.withColumn("Time", F.when(F.col("V1").isin(7.0, 20.0), F.concat(F.lit("x"), time)).otherwise(time))
    parts = []
    for n, (batch, rows) in enumerate(DELIVERIES, 1):
        path = _write_source((raw if n > 1 else broken).filter(rows), f"{source}/{n}")
        jobs.ingest_transactions(path, "2024-02-01", batch)
        load(jobs)
        owned = read_table(spark, jobs.layout.silver("transactions")).groupBy(
            F.col("batch_id").alias("owner"), F.col("V1").cast("bigint").alias("user_number")
        )
        owned = owned.agg(F.count(F.lit(1)).alias("transactions"), exact_sum("amount").alias("total_amount"))
        wrong = read_or_empty(spark, rejected(jobs.layout.bronze("transactions")), f"{BAD_RECORD} string").count()
        state = owned.select(F.lit(n).alias("delivery"), "*", F.lit(wrong).cast("bigint").alias("rejected_rows"))
        # The next delivery changes the files that this state is read from.
        parts.append(stage(state, scratch_path(spark, "correction")))
    return reduce(DataFrame.unionByName, parts)


def batch_correction(spark, sf_dir):
    """Corrected deliveries of two sources that share transactions, loaded in batches."""
    return _batch_correction(spark, sf_dir, lambda jobs: jobs.silver_transactions())


def stream_batch_correction(spark, sf_dir):
    """The same deliveries, loaded by the stream."""
    progress = scratch_path(spark, "correction-progress")
    return _batch_correction(
        spark, sf_dir, lambda jobs: start_silver_load(spark, jobs.layout, progress).awaitTermination()
    )


# Three deliveries of events: each repeats the last days of the one before, the last one brings rows that are late.
HELD_BACK = "event_id % 97 = 5 AND ts < TIMESTAMP'2024-01-05'"
EVENT_DELIVERIES = (
    f"ts < TIMESTAMP'2024-01-11' AND NOT ({HELD_BACK})",
    "ts >= TIMESTAMP'2024-01-08' AND ts < TIMESTAMP'2024-01-21'",
    f"ts >= TIMESTAMP'2024-01-18' OR ({HELD_BACK})",
)


def stream_stateful_dedup(spark, sf_dir):
    """Events per day after a stream that remembers keys for five days, its rows and the late ones among them."""
    events = views.table(spark, sf_dir, "events").select(
        "event_id", "value", F.col("ts").cast("timestamp").alias("ts"), F.to_date("ts").alias("event_date")
    )
    source, target, progress = (scratch_path(spark, f"distinct-{n}") for n in ("source", "target", "progress"))
    runs = []
    for rows in EVENT_DELIVERIES:
        events.filter(rows).write.mode("append").parquet(source)
        runs.append(
            load_distinct(spark, source, events.schema, ["event_id"], "ts", "5 days", target, progress, ["event_date"])
        )
    return read_table(spark, target).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"),
        exact_sum("value").alias("total"),
        F.lit(sum(r.rows_in for r in runs)).cast("bigint").alias("rows_in"),
        F.lit(sum(r.late_rows for r in runs)).cast("bigint").alias("late_rows"),
    )


# What source "a" holds when it is corrected: these users' events up to FIRST_BATCH_END.
CORRECTED = "V1 <= 100"


def mart_refresh(spark, sf_dir):
    """Marts refreshed after each of three loads (two halves of the days, then the first half corrected).

    `differences` counts rows by which any mart differs from one that is built from all facts.
    """
    jobs, source = _lake(spark, sf_dir)
    overwrite(views.customers(spark, sf_dir), jobs.layout.gold("dim_customer"))
    first, second = _halves(spark, sf_dir)
    parts = []
    for n, (batch, rows) in enumerate((("a", first), ("b", second), ("a", first.filter(CORRECTED))), 1):
        jobs.ingest_transactions(_write_source(rows, f"{source}/{n}"), "2024-02-01", batch)
        jobs.silver_transactions()
        jobs.date_dimension()
        jobs.refresh()
        parts.append(stage(_mart_state(jobs, n), scratch_path(spark, "refreshed")))
    return reduce(DataFrame.unionByName, parts)


def _mart_state(jobs, delivery):
    """Every day and month, and all customers together."""

    def gold(name):
        return read_table(jobs.spark, jobs.layout.gold(name))

    calendar, customers = gold("dim_date"), gold("dim_customer")
    fact = build_fact(read_table(jobs.spark, jobs.layout.silver("transactions")), customers)
    daily, monthly = gold("daily_transaction_summary"), gold("monthly_revenue_summary")
    activity = gold("customer_activity_summary")
    different = F.lit(0).cast("bigint")
    for mart, full in (
        (daily, marts.daily_summary(fact, calendar)),
        (monthly, marts.monthly_summary(fact, calendar)),
        (activity, marts.customer_activity(fact, customers)),
        (gold("fraud_rate_by_day"), marts.fraud_rate_by_day(marts.daily_summary(fact, calendar))),
    ):
        full = full.select(mart.columns)
        odd = mart.exceptAll(full).unionByName(full.exceptAll(mart))
        different += F.lit(odd.count())
    measures = ["total_transactions", "total_amount", "fraud_count", "fraud_rate"]
    lifetime = activity.agg(
        F.sum("transaction_count").alias("total_transactions"),
        exact_sum("total_spent").alias("total_amount"),
        F.sum("fraud_count").alias("fraud_count"),
    ).withColumn("fraud_rate", rate("fraud_count", "total_transactions"))
    rows = [
        daily.select(F.lit("day").alias("level"), F.col("date_sk").alias("period"), *measures),
        monthly.select(F.lit("month").alias("level"), (F.col("year") * 100 + F.col("month")).alias("period"), *measures),
        lifetime.select(F.lit("all").alias("level"), F.lit(0).alias("period"), *measures),
    ]
    return reduce(DataFrame.unionByName, rows).withColumns(
        {"delivery": F.lit(delivery), "differences": different}
    )


def _daily(silver):
    return silver.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("transactions"),
        exact_sum("amount").alias("total_amount"),
        F.sum("fraud_flag").alias("fraud_count"),
    )


def stream_silver(spark, sf_dir):
    """The streaming form of the Silver load, run twice over one Bronze table."""
    jobs, source = _lake(spark, sf_dir)
    jobs.ingest_transactions(_write_source(views.raw_transactions(spark, sf_dir), source), "2024-02-01")
    progress = scratch_path(spark, "silver-progress")
    for _ in range(2):
        start_silver_load(spark, jobs.layout, progress).awaitTermination()
    return _daily(read_table(spark, jobs.layout.silver("transactions")))


def stream_silver_small_batches(spark, sf_dir):
    """One file per micro-batch, then a new checkpoint, then the batch load: Silver holds every transaction once."""
    jobs, source = _lake(spark, sf_dir)
    for n, part in enumerate(_halves(spark, sf_dir), 1):
        jobs.ingest_transactions(_write_source(part, f"{source}/{n}"), "2024-02-01")
        start_silver_load(spark, jobs.layout, scratch_path(spark, "progress"), max_files=1).awaitTermination()
    jobs.silver_transactions()
    loaded = read_table(spark, jobs.layout.silver("transactions"))
    return loaded.groupBy(F.col("V1").cast("bigint").alias("user_number")).agg(
        F.count(F.lit(1)).alias("transactions"),
        exact_sum("amount").alias("total_amount"),
        F.sum("fraud_flag").alias("fraud_count"),
    )


def _customer_files(spark, sf_dir, jobs, days):
    """Ingest {day: rows} of customers as semicolon-separated files."""
    source = scratch_path(spark, "people")
    for day, rows in days.items():
        path = f"{source}/{day}"
        rows.write.option("header", True).option("sep", ";").csv(path)
        jobs.ingest_customers(path, CUSTOMER_SCHEMA, day)


CUSTOMER_SCHEMA = T.StructType().add("cust_key", "long").add("acct.bal", "double").add("y", "string")


def _people(spark, sf_dir, lift=0.0):
    return views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cust_key"),
        (F.col("c_acctbal") + F.lit(lift)).alias("acct.bal"),
        F.when(F.col("c_mktsegment") == "BUILDING", "yes").otherwise("no").alias("y"),
    )


def customers_two_days(spark, sf_dir):
    """Odd customers on the first day; even ones, and every fifth again with another balance, on the second."""
    jobs = Jobs(spark, Layout(scratch_path(spark, "lake")))
    first = _people(spark, sf_dir).filter("cust_key % 2 = 1")
    second = _people(spark, sf_dir, 8192.0).filter("cust_key % 2 = 0 OR cust_key % 5 = 0")
    for day, rows in (("2024-01-01", first), ("2024-01-02", second)):
        _customer_files(spark, sf_dir, jobs, {day: rows})
        jobs.silver_customers("cust_key")
    silver = read_table(spark, jobs.layout.silver("customers"))
    ids = F.struct(F.min("customer_id").alias("low"), F.max("customer_id").alias("high"))
    return silver.groupBy((F.col("cust_key") % 2).alias("odd")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.countDistinct("customer_id").alias("ids"),
        ids.getField("low").alias("lowest"),
        ids.getField("high").alias("highest"),
        exact_sum("acct_bal").alias("balance"),
        F.max("ingest_date").alias("newest"),
    )


def _history(jobs, spark, sf_dir, days):
    """The customer dimension after each day's file was ingested and merged."""
    for n, (day, rows) in enumerate(days.items()):
        _customer_files(spark, sf_dir, jobs, {day: rows})
        jobs.silver_customers("cust_key")
        jobs.update_customer_dimension(day) if n else jobs.customer_dimension(day)
    dimension = read_table(spark, jobs.layout.gold("dim_customer"))
    return dimension.select("cust_key", "acct_bal", "response_flag", "valid_from", "valid_to", "is_current")


def scd2_repeat(spark, sf_dir):
    """The same customers on two days: nothing changes."""
    jobs, people = Jobs(spark, Layout(scratch_path(spark, "lake"))), _people(spark, sf_dir)
    return _history(jobs, spark, sf_dir, {"2024-01-01": people, "2024-01-02": people})


def scd2_renumber(spark, sf_dir):
    """Customers before the first key come on the second day: the others keep their version."""
    jobs, people = Jobs(spark, Layout(scratch_path(spark, "lake"))), _people(spark, sf_dir)
    return _history(jobs, spark, sf_dir, {"2024-01-01": people.filter("cust_key >= 10"), "2024-01-02": people})


QUERIES = {
    "q_stream_stateful_dedup": stream_stateful_dedup,
    "q_mart_refresh": mart_refresh,
    "q_batch_correction": batch_correction,
    "q_stream_batch_correction": stream_batch_correction,
    "q_bronze_two_files_one_day": bronze_two_files_one_day,
    "q_silver_repeated_file": silver_repeated_file,
    "q_stream_silver_small_batches": stream_silver_small_batches,
    "q_csv_bad_records": csv_bad_records,
    "q_customers_two_days": customers_two_days,
    "q_scd2_repeat": scd2_repeat,
    "q_scd2_renumber": scd2_renumber,
    "q_stream_silver": stream_silver,
    "q_csv_roundtrip": csv_roundtrip,
    "q_partitioned_append": partitioned_append,
    "q_partition_replace": partition_replace,
    "q_overwrite_roundtrip": overwrite_roundtrip,
    "q_incremental_filter": incremental_filter,
    "q_incremental_high_mark": incremental_high_mark,
    "q_stream_incremental": stream_incremental,
    "q_silver_customers": silver_customers,
    "q_silver_transactions": silver_transactions,
    "q_transaction_key": transaction_key,
    "q_silver_load": silver_load,
}

SILVER_DAILY_SQL = f"""
    SELECT transaction_date, COUNT(*) AS transactions, {money("amount")} AS total_amount,
        CAST(SUM(fraud_flag) AS BIGINT) AS fraud_count
    FROM ({SILVER_SQL}) GROUP BY transaction_date
"""


def _correction_sql() -> str:
    parts = []
    for n, owned in enumerate(OWNED, 1):
        wrong = "(SELECT COUNT(*) FROM events WHERE user_id + 1 IN (7, 20))" if n <= 2 else "0"
        sound = " AND V1 NOT IN (7, 20)" if n <= 2 else ""
        for owner, rows in owned:
            parts.append(f"""
                SELECT {n} AS delivery, '{owner}' AS owner, user_id + 1 AS user_number, COUNT(*) AS transactions,
                    {money("amount")} AS total_amount, CAST({wrong} AS BIGINT) AS rejected_rows
                FROM ({SILVER_SQL}) WHERE ({rows}){sound} GROUP BY user_id
            """)
    return " UNION ALL ".join(parts)


def _refresh_sql() -> str:
    early = f"CAST(ts AS DATE) <= DATE '{FIRST_BATCH_END}'"
    held = (early, "TRUE", f"NOT ({early}) OR user_id + 1 <= 100")
    parts = []
    for n, rows in enumerate(held, 1):
        silver = SILVER_SQL.replace("FROM events)", f"FROM events WHERE {rows})")
        for level, period in (
            ("day", "CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER)"),
            ("month", "CAST(strftime(transaction_date, '%Y%m') AS INTEGER)"),
            ("all", "0"),
        ):
            parts.append(f"""
                SELECT {n} AS delivery, '{level}' AS level, {period} AS period, COUNT(*) AS total_transactions,
                    {money("amount")} AS total_amount, CAST(SUM(fraud_flag) AS BIGINT) AS fraud_count,
                    ROUND(SUM(fraud_flag) / COUNT(*), 4) AS fraud_rate, 0::BIGINT AS differences
                FROM ({silver}) GROUP BY period
            """)
    return " UNION ALL ".join(parts)


def _first_versions(valid_from: str) -> str:
    return f"""
        SELECT c_custkey AS cust_key, c_acctbal AS acct_bal,
            CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS response_flag,
            {valid_from} AS valid_from, CAST(NULL AS DATE) AS valid_to, 1 AS is_current
        FROM customer
    """


_ROWS_IN = " + ".join(f"COUNT(*) FILTER ({rows})" for rows in EVENT_DELIVERIES)

ORACLE = {
    "q_stream_stateful_dedup": f"""
        SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS events, {money("value")} AS total,
            (SELECT {_ROWS_IN} FROM events) AS rows_in, (SELECT COUNT(*) FROM events WHERE {HELD_BACK}) AS late_rows
        FROM events WHERE NOT ({HELD_BACK}) GROUP BY 1
    """,
    "q_mart_refresh": _refresh_sql(),
    "q_batch_correction": _correction_sql(),
    "q_stream_batch_correction": _correction_sql(),
    "q_csv_roundtrip": """
        SELECT 'part' AS source, p_partkey AS id, p_name || ', "' || p_brand || '"; ' || p_type AS label,
            p_retailprice AS amount FROM part
        UNION ALL
        SELECT 'customer', c_custkey, c_name || '; "' || c_mktsegment || '", ', c_acctbal FROM customer
    """,
    "q_partitioned_append": """
        SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month
        FROM orders
    """,
    "q_partition_replace": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "q_overwrite_roundtrip": "SELECT o_orderkey, o_orderpriority FROM orders",
    "q_incremental_filter": f"""
        SELECT event_id AS transaction_sk, user_id AS customer_sk, value AS amount,
            CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fraud_flag, CAST(ts AS DATE) AS ingest_date
        FROM events WHERE CAST(ts AS DATE) > DATE '{FIRST_BATCH_END}'
    """,
    "q_incremental_high_mark": """
        SELECT 'events' AS source, CAST(CAST(MAX(ts) AS DATE) AS VARCHAR) AS high_mark FROM events
        UNION ALL SELECT 'orders', CAST(CAST(MAX(o_orderdate) AS DATE) AS VARCHAR) FROM orders
    """,
    "q_stream_incremental": f"""
        SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS events, {money("value")} AS total FROM events GROUP BY 1
    """,
    "q_silver_customers": """
        SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS customer_id, c_custkey AS cust_key, c_name AS name,
            c_acctbal AS acct_bal, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS response_flag
        FROM customer
    """,
    "q_silver_transactions": f"""
        SELECT (user_id + 1) * 7919 % (SELECT COUNT(*) FROM customer) AS customer_id, * EXCLUDE (user_id)
        FROM ({SILVER_SQL})
    """,
    "q_transaction_key": f"SELECT COUNT(*) AS silver_rows, COUNT(*) AS transaction_keys FROM ({SILVER_SQL})",
    "q_silver_load": SILVER_DAILY_SQL,
    "q_bronze_two_files_one_day": SILVER_DAILY_SQL,
    "q_silver_repeated_file": SILVER_DAILY_SQL,
    "q_stream_silver_small_batches": f"""
        SELECT user_id + 1 AS user_number, COUNT(*) AS transactions, {money("amount")} AS total_amount,
            CAST(SUM(fraud_flag) AS BIGINT) AS fraud_count
        FROM ({SILVER_SQL}) GROUP BY user_id
    """,
    "q_csv_bad_records": """
        SELECT COUNT(*) FILTER (user_id <> 7) AS good_rows, 0::BIGINT AS good_without_time,
            COUNT(*) FILTER (user_id = 7) AS bad_rows, COUNT(*) FILTER (user_id = 7) AS bad_with_text
        FROM events
    """,
    "q_customers_two_days": f"""
        SELECT odd, COUNT(*) AS customers, COUNT(*) AS ids, MIN(id) AS lowest, MAX(id) AS highest,
            {money("balance")} AS balance, DATE '2024-01-02' AS newest
        FROM (
            SELECT c_custkey % 2 AS odd, row_number() OVER (ORDER BY c_custkey % 2 DESC, c_custkey) - 1 AS id,
                c_acctbal + CASE WHEN c_custkey % 2 = 0 OR c_custkey % 5 = 0 THEN 8192.0::DOUBLE ELSE 0 END AS balance
            FROM customer
        ) GROUP BY odd
    """,
    "q_scd2_repeat": _first_versions("DATE '2024-01-01'"),
    "q_scd2_renumber": _first_versions("CASE WHEN c_custkey >= 10 THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END"),
    "q_stream_silver": SILVER_DAILY_SQL,
}
