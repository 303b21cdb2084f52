"""The transaction fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.functions.keys import date_key
from lakepipe.operators.joins import lookup_join
from lakepipe.operators.quality import NotNull, UniqueKey

# The columns of the fact table.
FACT_COLUMNS = ("transaction_sk", "customer_sk", "date_sk", "amount", "fraud_flag")
FACT_RULES = (NotNull("transaction_sk"), UniqueKey(("transaction_sk",)))


def version_lists(customers: DataFrame) -> DataFrame:
    """(customer_id, starts, versions): one row a customer, its versions by the day they start on.

    At most one version starts on a day, so a list is as long as the calendar at most.
    """
    listed = customers.groupBy("customer_id").agg(
        F.sort_array(F.collect_list(F.struct("valid_from", "customer_sk"))).alias("_all")
    )
    return listed.select(
        "customer_id", F.col("_all.valid_from").alias("starts"), F.col("_all.customer_sk").alias("versions")
    )


def version_on(day: Column, steps: int) -> Column:
    """The version of `version_lists` that counts on a day, by binary search in `steps` steps.

    A version ends where the next one starts. The first one is open to the past and the last one to
    the future, ended or not, so every day of a known customer belongs to exactly one version; a
    missing day belongs to the first.
    """
    starts = F.col("starts")

    def further(place: Column, step: Column) -> Column:
        begun = F.get(starts, place + step - 1) <= day
        return place + F.when(begun, step).otherwise(F.lit(0))

    sizes = F.array(*[F.lit(1 << i) for i in reversed(range(steps))])
    begun = F.aggregate(sizes, F.lit(0), further)
    return F.get(F.col("versions"), F.greatest(begun, F.lit(1)) - 1)


def build_fact(transactions: DataFrame, customers: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Transactions of known customers with the surrogate keys of the star schema.

    A transaction gets the version of its customer that was valid on its day, found in the customer's
    one list of versions, so it meets one row however many versions there are; a dimension without
    validity dates has one version each. The transaction's own id is its surrogate key. Dates
    outside the calendar stay (see operators.quality.orphans); since the calendar side is distinct
    and adds no column, Catalyst drops that join.
    """
    needed = transactions.select("transaction_id", "customer_id", "transaction_date", "amount", "fraud_flag")
    if "valid_from" in customers.columns:
        lists = version_lists(customers)
        longest = lists.agg(F.max(F.size("starts"))).first()[0] or 0
        known = lookup_join(needed, lists, ["customer_id"], spread=["transaction_id"])
        version = version_on(F.col("transaction_date"), longest.bit_length())
        known = known.withColumn("customer_sk", version).drop("starts", "versions")
    else:
        current = customers.filter("is_current = 1").select("customer_id", "customer_sk")
        known = lookup_join(needed, current, ["customer_id"], spread=["transaction_id"])
    fact = known.withColumn("date_sk", date_key("transaction_date")).withColumnRenamed(
        "transaction_id", "transaction_sk"
    )
    if calendar is not None:
        fact = fact.join(calendar.select("date_sk").distinct(), "date_sk", "left")
    return fact.select(*FACT_COLUMNS)
