"""Bronze to Silver: cleaning, deduplication, keys, checks and the incremental load."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.functions.keys import bucket_of, jump_bucket, row_key, row_token
from lakepipe.functions.times import source_timestamp
from lakepipe.layout import Layout
from lakepipe.operators.dedup import keep_first, keep_first_desc
from lakepipe.operators.ordering import dense_ids, dense_row_ids
from lakepipe.operators.quality import (
    AllowedValues,
    NotNull,
    UniqueKey,
    quality_report,
    require_clean,
)
from lakepipe.plans import ledger
from lakepipe.plans.bronze import BATCH, BATCH_COLUMNS, BRONZE_TRANSACTIONS, FEATURE_COLUMNS
from lakepipe.plans.refresh import note_days
from lakepipe.session import methods_compiled, shuffles_removed
from lakepipe.sources.readers import read_or_empty, read_table
from lakepipe.sources.state import customer_count_of, customer_counts, first_loads, note_batch, pending_batches
from lakepipe.sources.writers import (
    leaf_folders,
    overwrite,
    publish_folders,
    remove,
    stage,
    subfolders,
    write_partitioned,
)

BUSINESS_COLUMNS = [*FEATURE_COLUMNS, "amount", "fraud_flag"]
SILVER_SCHEMA = ", ".join(
    [
        "transaction_id string, customer_id bigint, transaction_timestamp timestamp_ntz",
        *[f"{c} double" for c in FEATURE_COLUMNS],
        f"amount double, fraud_flag int, ingest_date date, transaction_date date, {BATCH} string",
    ]
)
TRANSACTION_RULES = (
    NotNull("transaction_id"),
    NotNull("customer_id"),
    NotNull("transaction_date"),
    NotNull("amount"),
    AllowedValues("fraud_flag", (0, 1)),
    UniqueKey(("transaction_id",)),
)


def clean_customers(df: DataFrame, response: str = "y", yes: str = "yes") -> DataFrame:
    """Dot-free column names and a 1/0 response flag."""
    clean = df.withColumnsRenamed({c: c.replace(".", "_") for c in df.columns if "." in c})
    flag = F.when(F.col(response) == yes, 1).otherwise(0)
    return clean.withColumn("response_flag", flag).drop(response)


def transform_customers(
    df: DataFrame, key: str | None = None, response: str = "y", yes: str = "yes"
) -> DataFrame:
    """Dot-free column names, a 1/0 response flag and a dense customer_id in front.

    Ids are 0..N-1 without gaps, in the order of `key` when there is one; transactions are
    assigned to customers by number, so a gap would lose rows.
    """
    clean = clean_customers(df, response, yes)
    numbered = dense_ids(clean, key, "customer_id") if key else dense_row_ids(clean, "customer_id")
    return numbered.select("customer_id", *clean.columns)


def transform_transactions(
    df: DataFrame, customer_count: Column | int, draw: Column | None = None, within: Sequence[str] = ()
) -> DataFrame:
    """Typed, deduplicated transactions with keys.

    Of rows equal in every business column, and in the columns `within`, the earliest stays.
    `transaction_id` is a hash of the business columns and customer_id a bucket that such a hash falls
    into (or `draw` modulo the number of customers), so a repeated load gives the same ids; when
    customers are added few transactions would change theirs.
    """
    needed = _business_rows(df, within)
    return _silver_rows(_earliest(needed, within), customer_count, draw, within)


def _business_rows(df: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    named = df.withColumnsRenamed({"Class": "fraud_flag", "Amount": "amount"})
    return named.select("Time", *BUSINESS_COLUMNS, "ingest_date", *within)


def _earliest(rows: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return keep_first(rows, [*BUSINESS_COLUMNS, *within], ["ingest_date", "Time"])


def _transaction_date() -> Column:
    return F.to_date(source_timestamp("Time"))


def _silver_rows(
    rows: DataFrame, customer_count: Column | int, draw: Column | None = None, within: Sequence[str] = ()
) -> DataFrame:
    """Rows that are one per transaction with their keys and times; a `transaction_id` that they have is taken."""
    if draw is None:
        customer = jump_bucket(row_token(*BUSINESS_COLUMNS), customer_count)
    else:
        customer = bucket_of(draw, customer_count)
    key = F.col("transaction_id") if "transaction_id" in rows.columns else row_key(*BUSINESS_COLUMNS)
    return (
        rows.withColumn("transaction_timestamp", source_timestamp("Time"))
        .withColumns(
            {
                "transaction_date": F.to_date("transaction_timestamp"),
                "customer_id": customer,
                "transaction_id": key,
            }
        )
        .select(
            "transaction_id",
            "customer_id",
            "transaction_timestamp",
            "transaction_date",
            *BUSINESS_COLUMNS,
            "ingest_date",
            *within,
        )
    )


def natural_keys(bronze: DataFrame, key: str | None) -> DataFrame:
    """The newest row of every customer over all ingested days, with `_natural`, its key as text.

    Without a key column a customer is a row's content; rows that one batch holds several times
    are that many customers, told apart by a running number.
    """
    if key is not None:
        newest = keep_first_desc(bronze, [key], BATCH_COLUMNS)
        return newest.drop(BATCH).withColumn("_natural", F.col(f"`{key}`").cast("string"))
    content = [f"`{c}`" for c in bronze.columns if c not in BATCH_COLUMNS]
    counts = bronze.groupBy(*content, *BATCH_COLUMNS).agg(F.count(F.lit(1)).alias("_copies"))
    newest = counts.groupBy(*content).agg(F.max("_copies").alias("_copies"), F.max("ingest_date").alias("ingest_date"))
    numbered = newest.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    natural = F.concat_ws("-", row_key(*content), F.col("_copy").cast("string"))
    return numbered.withColumn("_natural", natural).drop("_copies", "_copy")


def load_customers(spark: SparkSession, layout: Layout, key: str | None = None) -> None:
    """Rebuild Silver customers from all of Bronze; ids stay what they were.

    A table of its own maps natural keys to ids. It is only appended to: new customers get the ids
    after the highest one, so a customer keeps the id whatever other customers come or go.
    """
    rows = natural_keys(read_table(spark, layout.bronze("customers")), key)
    map_path = layout.silver("customer_ids")
    known = read_or_empty(spark, map_path, "_natural string, customer_id bigint")
    highest = known.agg(F.max("customer_id")).first()[0]
    added = rows.select("_natural").join(known, "_natural", "left_anti")
    staging = layout.staging("customer_ids", uuid.uuid4().hex)
    added = stage(added, staging)
    if not added.isEmpty():
        numbered = dense_ids(added, "_natural", "customer_id", start=0 if highest is None else highest + 1)
        numbered.select("_natural", "customer_id").write.mode("append").parquet(map_path)
    remove(spark, staging)
    with_ids = clean_customers(rows).join(read_table(spark, map_path), "_natural").drop("_natural")
    first = ["customer_id", *[c for c in with_ids.columns if c != "customer_id"]]
    overwrite(with_ids.select(first), layout.silver("customers"))


def load_transactions(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """Load every Bronze batch that has not been loaded as it is; returns its rows, or None without new batches.

    A batch that was ingested again is corrected: what it no longer holds goes, see `load_batch`.
    """
    finished = finish_loads(spark, layout)
    pending = pending_batches(spark, layout.batches, "transactions")
    for batch in pending:
        load_batch(spark, layout, batch)
    loaded = sorted({*finished, *pending})
    return silver_transactions(spark, layout).filter(F.col(BATCH).isin(loaded)) if loaded else None


def silver_transactions(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_or_empty(spark, layout.silver("transactions"), SILVER_SCHEMA)


def load_batch(spark: SparkSession, layout: Layout, batch: str) -> None:
    """Make Silver hold what Bronze now holds of one batch.

    Of equal transactions Silver has one, that of the batch loaded first; inside a batch the earliest.
    A ledger knows which batches hold a transaction and which one owns it. So the load is a
    difference: the batch's rows that no other batch owns replace those it owned, and transactions it
    has withdrawn come back from the batch loaded first among the others that hold them, if any.

    All of this is decided on keys alone. Wide rows are read when it is known which of them Silver gets;
    they move once, to the folders they are written for.

    The new content of every folder the load touches, or what is added to it, is staged as a plan and
    checked first. Only then is anything changed, folder by folder. A load that breaks off before
    its plan is complete has changed nothing; one that breaks off later is finished by the next load,
    which moves what was not moved yet. One load runs at a time.
    """
    with methods_compiled(spark), shuffles_removed(spark):
        plan = f"{layout.load_plans}/{uuid.uuid4().hex}"
        _make_plan(spark, layout, plan, batch)
        _carry_out(spark, layout, plan, batch)


def _make_plan(spark: SparkSession, layout: Layout, plan: str, batch: str) -> None:
    customers = read_table(spark, layout.silver("customers"))
    customer_count = customer_count_of(spark, layout.customer_counts, batch, customers)
    bronze = read_or_empty(spark, layout.bronze("transactions"), BRONZE_TRANSACTIONS)
    rows = _keyed(bronze.filter(F.col(BATCH) == batch))
    days = rows.select("transaction_id", _transaction_date().alias("transaction_date"), "ingest_date")
    keys = stage(ledger.distinct_keys(days), f"{plan}/keys")
    known = read_or_empty(spark, layout.silver("transaction_ledger"), ledger.SCHEMA)
    before = first_loads(spark, layout.batches, "transactions")
    heirs = None
    if before.filter(F.col(BATCH) == batch).isEmpty():
        entries = ledger.addition(keys, batch, known).entries
    else:
        fates = stage(ledger.correction(keys, batch, known, before), f"{plan}/fates")
        entries = fates.filter("owned IS NOT NULL").select(
            ledger.KEY, "owned", "transaction_date", F.lit(batch).alias(BATCH)
        )
        heirs = fates.filter("owned IS NULL").select(
            ledger.KEY, F.col("heir_date").alias("transaction_date"), F.col("heir").alias(BATCH)
        )
    write_partitioned(entries, f"{plan}/ledger", ledger.FOLDER)
    decided = read_or_empty(spark, f"{plan}/ledger", ledger.SCHEMA)

    wanted, unwanted = (decided.filter(c).select(ledger.KEY) for c in (F.col("owned"), ~F.col("owned")))
    repeated = keys.filter("copies > 1").select(ledger.KEY)

    def odd() -> DataFrame:
        copies = repeated.join(unwanted, ledger.KEY, "left_anti").withColumn("wanted", F.lit(True))
        return stage(unwanted.withColumn("wanted", F.lit(False)).unionByName(copies), f"{plan}/odd_keys")

    chosen = _silver_rows(_chosen(rows, [ledger.KEY], wanted, odd), customer_count)
    write_partitioned(chosen.withColumn(BATCH, F.lit(batch)), f"{plan}/transactions", ledger.FOLDER)
    written = read_or_empty(spark, f"{plan}/transactions", SILVER_SCHEMA)
    if heirs is not None and not heirs.isEmpty():
        _plan_heirs(spark, layout, plan, bronze, known, heirs, customer_count)
        written = written.unionByName(read_or_empty(spark, f"{plan}/returned", SILVER_SCHEMA))
    # The rules read few columns of what was written.
    require_clean(quality_report(written, "silver_transactions", TRANSACTION_RULES))
    _note_folders(spark, layout, plan, batch)
    stage(spark.range(1).select(F.lit(batch).alias(BATCH)), f"{plan}/{READY}")


def _keyed(bronze: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return _business_rows(bronze, within).withColumn("transaction_id", row_key(*BUSINESS_COLUMNS))


def _chosen(
    rows: DataFrame, by: Sequence[str], wanted: DataFrame, odd: Callable[[], DataFrame], within: Sequence[str] = ()
) -> DataFrame:
    """The rows whose keys are wanted, of equal ones the earliest.

    Wide rows meet whatever is less: the wanted keys, or the `odd` ones, which are all others and those that
    rows have several times (`wanted` tells which). Only copies are compared with each other. Where neither
    may be broadcast, rows are shuffled by their keys.
    """
    if ledger.few(wanted):
        return _earliest(rows.join(F.broadcast(wanted), by, "left_semi"), within)
    exceptions = odd()
    if not ledger.few(exceptions):
        return _earliest(rows.join(wanted, by, "left_semi"), within)
    once = rows.join(F.broadcast(exceptions), by, "left_anti")
    repeated = exceptions.filter("wanted")
    if repeated.isEmpty():
        return once
    return once.unionByName(_earliest(rows.join(F.broadcast(repeated), by, "left_semi"), within))


def _plan_heirs(
    spark: SparkSession,
    layout: Layout,
    plan: str,
    bronze: DataFrame,
    known: DataFrame,
    heirs: DataFrame,
    customer_count: int,
) -> None:
    """Stage what other batches get back: the ledger's entries of their folders, and the rows Silver is given."""
    folders = stage(heirs.select(*ledger.FOLDER).distinct(), f"{plan}/folders")
    few = ledger.few(heirs)
    entries = ledger.pass_on(known, F.broadcast(heirs) if few else heirs, folders)
    # Few heirs are met where the entries are read, which is folder by folder already.
    write_partitioned(entries, f"{plan}/passed_on", ledger.FOLDER, rebalance=not few)

    sources = [r[BATCH] for r in folders.select(BATCH).distinct().collect()]
    by = [ledger.KEY, BATCH]
    held, wanted = _keyed(bronze.filter(F.col(BATCH).isin(sources)), [BATCH]), heirs.select(*by)

    def odd() -> DataFrame:
        no, yes = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
        both = held.select(*by, yes.alias("copies"), no.alias("wanted")).unionByName(
            wanted.select(*by, no.alias("copies"), yes.alias("wanted"))
        )
        met = both.groupBy(*by).agg(F.sum("copies").alias("copies"), F.max("wanted").alias("wanted"))
        met = met.filter("copies > 1 OR copies = 1 AND wanted = 0")
        return stage(met.select(*by, (F.col("wanted") == 1).alias("wanted")), f"{plan}/odd")

    # Every batch deals its transactions out among the customers there were when it came.
    counts = customer_counts(spark, layout.customer_counts).filter(F.col(BATCH).isin(sources))
    returned = _chosen(held, by, wanted, odd, [BATCH]).join(F.broadcast(counts), BATCH, "left")
    returned = returned.fillna(customer_count, ["customer_count"])
    returned = _silver_rows(returned, F.col("customer_count"), within=[BATCH])
    write_partitioned(returned, f"{plan}/returned", ledger.FOLDER)


def _note_folders(spark: SparkSession, layout: Layout, plan: str, batch: str) -> None:
    """Add to a plan which of the batch's folders nothing is left in, and the days it touches."""
    stale, days = [], set()
    for name, path in _tables(layout).items():
        staged = leaf_folders(spark, f"{plan}/{name}")
        for day in {f.partition("/")[0] for f in leaf_folders(spark, path) if f.endswith(f"/{BATCH}={batch}")}:
            if f"{day}/{BATCH}={batch}" not in staged:
                stale.append((name, day))
        days.update(f.partition("/")[0] for f in staged if name == "transactions")
    days.update(f.partition("/")[0] for f in leaf_folders(spark, f"{plan}/returned"))
    days.update(day for _, day in stale)
    stage(spark.createDataFrame(stale, "table_name string, folder string"), f"{plan}/stale")
    touched = [(d.partition("=")[2],) for d in sorted(days)]
    stage(spark.createDataFrame(touched, "transaction_date string"), f"{plan}/days")


def _tables(layout: Layout) -> dict[str, str]:
    return {"transactions": layout.silver("transactions"), "ledger": layout.silver("transaction_ledger")}


#: The part of a plan that is written last.
READY = "ready"


def _carry_out(spark: SparkSession, layout: Layout, plan: str, batch: str) -> None:
    """Change the tables as a complete plan says; doing it twice changes nothing more.

    The days it touches are noted first, for the next refresh of facts and marts. The batch's own folders
    are replaced; other batches' get their rows back as files of their own, and new ledger folders.
    """
    note_days(read_or_empty(spark, f"{plan}/days", "transaction_date string"), layout, plan.rpartition("/")[2])
    tables = _tables(layout)
    for name, path in tables.items():
        publish_folders(spark, f"{plan}/{name}", path)
    publish_folders(spark, f"{plan}/returned", tables["transactions"], replace=False)
    publish_folders(spark, f"{plan}/passed_on", tables["ledger"])
    # At most two folders for each day of one batch.
    for row in read_or_empty(spark, f"{plan}/stale", "table_name string, folder string").collect():
        remove(spark, f"{tables[row['table_name']]}/{row['folder']}/{BATCH}={batch}")
    note_batch(spark, layout.batches, "transactions", batch, "loaded")
    remove(spark, plan)


def finish_loads(spark: SparkSession, layout: Layout) -> list[str]:
    """Carry out plans that were complete when a load broke off, and drop the others; returns their batches."""
    batches = []
    for name in subfolders(spark, layout.load_plans):
        plan = f"{layout.load_plans}/{name}"
        ready = read_or_empty(spark, f"{plan}/{READY}", f"{BATCH} string").first()
        if ready is None:
            remove(spark, plan)
        else:
            _carry_out(spark, layout, plan, ready[BATCH])
            batches.append(ready[BATCH])
    return batches
