"""Which batches hold a transaction, and which one Silver has it from.

The ledger has a row for every transaction of every batch, partitioned like Silver itself: by the
transaction's day in that batch, and by batch. At most one of a transaction's rows is `owned`; that
batch's row is the one in Silver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakepipe.plans.bronze import BATCH
from lakepipe.session import checkpoint

SCHEMA = f"transaction_id string, owned boolean, transaction_date date, {BATCH} string"
#: What a folder of Silver and of the ledger is named after.
FOLDER = ["transaction_date", BATCH]
KEY = "transaction_id"


@dataclass(frozen=True)
class Difference:
    """What a batch that is new changes: its rows for Silver, and its ledger entries."""

    owned_rows: DataFrame
    entries: DataFrame


#: Up to so many keys (some 60 MB) are broadcast to the rows they meet; more are shuffled with them.
BROADCAST_KEYS = 500_000

# A day as a number that is not negative, and a number above all of them.
_DAY_ZERO, _DAYS = 50_000_000, 100_000_000


def _day_number(day: str) -> Column:
    return F.unix_date(day).cast("bigint") + _DAY_ZERO


def _day_of(number: Column) -> Column:
    return F.date_from_unix_date((number - _DAY_ZERO).cast("int"))


def few(keys: DataFrame) -> bool:
    """Whether keys may be broadcast."""
    return keys.count() <= BROADCAST_KEYS


def distinct_keys(rows: DataFrame) -> DataFrame:
    """(transaction_id, transaction_date, copies) of a batch's transactions: the day of the earliest copy.

    The earliest is the first by `ingest_date` and time, and the day follows from the time, so both travel as
    one number; a missing day comes first, as it does in order.
    """
    day = F.coalesce(_day_number("transaction_date"), F.lit(0).cast("bigint"))
    first = F.coalesce(_day_number("ingest_date"), F.lit(0).cast("bigint")) * _DAYS + day
    keys = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("copies"), F.min(first).alias("_first"))
    number = F.col("_first") % _DAYS
    return keys.select(KEY, F.when(number > 0, _day_of(number)).alias("transaction_date"), "copies")


def addition(rows: DataFrame, batch: str, known: DataFrame) -> Difference:
    """The rows of a batch that the ledger `known` has nothing of, unique by transaction.

    The ledger is read once, two narrow columns, and reduced to the transactions concerned before
    anything is shuffled; a ledger or a batch that may be broadcast meets the other without a shuffle.
    """
    others = known.filter(F.col("owned") & (F.col(BATCH) != batch)).select(KEY)
    if few(others):
        return _owned(rows, batch, checkpoint(rows.select(KEY).join(F.broadcast(others), KEY, "left_semi")))
    return _owned(rows, batch, checkpoint(others.join(rows.select(KEY), KEY, "left_semi")))


def _owned(rows: DataFrame, batch: str, taken: DataFrame) -> Difference:
    """What the batch owns of its rows: those not `taken`, keys that are counted before wide rows meet them."""
    count = taken.count()
    taken = F.broadcast(taken) if count <= BROADCAST_KEYS else taken
    entries = rows.select(KEY, "transaction_date").join(taken.withColumn("_taken", F.lit(True)), KEY, "left")
    owned = F.col("_taken").isNull().alias("owned")
    entries = entries.select(KEY, owned, "transaction_date", F.lit(batch).alias(BATCH))
    if count == 0:
        return Difference(rows, entries)
    if count <= BROADCAST_KEYS:
        return Difference(rows.join(taken, KEY, "left_anti"), entries)
    # Where others own nearly all, the few keys left pick their rows without a shuffle.
    free = checkpoint(rows.select(KEY).join(taken, KEY, "left_anti"))
    left = free.count()
    return Difference(rows.join(F.broadcast(free) if left <= BROADCAST_KEYS else free, KEY, "left_semi"), entries)


def correction(rows: DataFrame, batch: str, known: DataFrame, first_loads: DataFrame) -> DataFrame:
    """What becomes of every transaction that a batch holds or has withdrawn, by the ledger `known`.

    `rows` are the batch's transactions, unique. Returns (transaction_id, transaction_date, owned, heir, heir_date):
    those the batch holds with `owned` true or false, and without it those it owned and no longer holds that
    go to an heir: of the other batches that hold one, that with the earliest of `first_loads`; ties go by name.

    All that is known of a transaction meets in one shuffle of narrow rows. A batch whose keys may be broadcast
    reduces the ledger to them first.
    """
    own, others = known.filter(F.col(BATCH) == batch), known.filter(F.col(BATCH) != batch)
    concerned = rows.select(KEY).unionByName(own.select(KEY))
    if few(concerned):
        others = others.join(F.broadcast(concerned), KEY, "left_semi")
    # One row per batch.
    batches = known.select(BATCH).distinct().join(first_loads, BATCH, "left")
    by_age = Window.orderBy(F.col("first_loaded").isNull(), "first_loaded", BATCH)
    ranks = checkpoint(batches.select(F.col(BATCH).alias("heir"), F.row_number().over(by_age).cast("bigint").alias("rank")))
    others = others.join(F.broadcast(ranks), F.col(BATCH) == F.col("heir"))

    none, no = F.lit(None), F.lit(False)

    def facts(df: DataFrame, day: Column, here: Column, was: Column, taken: Column, place: Column) -> DataFrame:
        return df.select(
            KEY,
            day.cast("date").alias("transaction_date"),
            here.alias("here"),
            was.alias("was"),
            taken.alias("taken"),
            place.cast("bigint").alias("place"),
        )

    met = (
        facts(rows, F.col("transaction_date"), F.lit(True), no, no, none)
        .unionByName(facts(own, none, no, F.col("owned"), no, none))
        .unionByName(facts(others, none, no, no, F.col("owned"), F.col("rank") * _DAYS + _day_number("transaction_date")))
        .groupBy(KEY)
        .agg(
            F.max("transaction_date").alias("transaction_date"),
            F.max("here").alias("here"),
            F.max("was").alias("was"),
            F.max("taken").alias("taken"),
            F.min("place").alias("place"),
        )
    )
    inherited = ~F.col("here") & F.col("was") & F.col("place").isNotNull()
    fates = met.withColumn("place", F.when(inherited, F.col("place"))).filter("here OR place IS NOT NULL")
    day = F.col("place") % _DAYS
    fates = fates.select(
        KEY,
        "transaction_date",
        F.when(F.col("here"), ~F.col("taken")).alias("owned"),
        ((F.col("place") - day) / _DAYS).cast("bigint").alias("rank"),
        _day_of(day).alias("heir_date"),
    )
    return fates.join(F.broadcast(ranks), "rank", "left").drop("rank")


def pass_on(known: DataFrame, heirs: DataFrame, folders: DataFrame) -> DataFrame:
    """All entries of the `folders` of the ledger `known`, those of `heirs` owned."""
    marked = heirs.withColumn("_heir", F.lit(True))
    entries = known.join(F.broadcast(folders), FOLDER, "left_semi").join(marked, [KEY, *FOLDER], "left")
    return entries.select(KEY, (F.col("owned") | F.col("_heir").isNotNull()).alias("owned"), *FOLDER)
