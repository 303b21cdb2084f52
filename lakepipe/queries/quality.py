"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.operators.quality import (
    AllowedValues,
    HasSchema,
    NotEmpty,
    NotNull,
    UniqueKey,
    availability_report,
    quality_report,
    repeated_keys,
)
from lakepipe.queries import views


def _orders(spark, sf_dir):
    """Orders where an unspecified priority is missing."""
    return views.table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')")
    )


def nulls(spark, sf_dir):
    rules = [NotNull("o_orderkey"), NotNull("o_orderpriority")]
    return quality_report(_orders(spark, sf_dir), "orders", rules)


def domain(spark, sf_dir):
    """A missing priority breaks the strict rule only."""
    urgent_or_high = ("1-URGENT", "2-HIGH")
    strict = AllowedValues("o_orderpriority", urgent_or_high)
    lenient = AllowedValues("o_orderpriority", urgent_or_high, nulls_pass=True)
    orders = _orders(spark, sf_dir)
    return quality_report(orders, "strict", [strict]).unionByName(quality_report(orders, "lenient", [lenient]))


def duplicates(spark, sf_dir):
    return repeated_keys(views.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def report(spark, sf_dir):
    expected = T.StructType.fromDDL("l_orderkey bigint, l_linenumber bigint, l_comment string")
    rules = [
        NotEmpty(),
        HasSchema(expected),
        NotNull("l_extendedprice"),
        AllowedValues("l_returnflag", ("A", "N")),
        UniqueKey(("l_orderkey", "l_linenumber")),
    ]
    return quality_report(views.table(spark, sf_dir, "lineitem"), "lineitem", rules)


TABLES = ("customer", "orders", "events", "not_there")


def availability(spark, sf_dir):
    """Which tables are there and have rows; one isn't."""
    return availability_report(spark, {name: f"{sf_dir}/{name}.parquet" for name in TABLES})


QUERIES = {
    "q_dq_availability": availability,
    "q_dq_nulls": nulls,
    "q_dq_domain": domain,
    "q_dq_duplicates": duplicates,
    "q_dq_report": report,
}

REPEATED_SQL = """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
"""

ORACLE = {
    "q_dq_availability": " UNION ALL ".join(
        [
            *[
                f"SELECT '{name}' AS table_name, 'available' AS rule, CAST(COUNT(*) = 0 AS BIGINT) AS violations FROM {name}"
                for name in TABLES[:-1]
            ],
            f"SELECT '{TABLES[-1]}', 'available', 1::BIGINT",
        ]
    ),
    "q_dq_nulls": """
        SELECT 'orders' AS table_name, 'not_null(o_orderkey)' AS rule,
            COUNT(*) FILTER (o_orderkey IS NULL) AS violations FROM orders
        UNION ALL SELECT 'orders', 'not_null(o_orderpriority)',
            COUNT(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') FROM orders
    """,
    "q_dq_domain": """
        SELECT 'strict' AS table_name, 'allowed_values(o_orderpriority)' AS rule,
            COUNT(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS violations FROM orders
        UNION ALL SELECT 'lenient', 'allowed_values(o_orderpriority)',
            COUNT(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED')) FROM orders
    """,
    "q_dq_duplicates": REPEATED_SQL,
    "q_dq_report": f"""
        SELECT 'lineitem' AS table_name, 'not_empty' AS rule,
            CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM lineitem
        UNION ALL SELECT 'lineitem', 'schema', 2
        UNION ALL SELECT 'lineitem', 'not_null(l_extendedprice)', COUNT(*) FILTER (l_extendedprice IS NULL)
            FROM lineitem
        UNION ALL SELECT 'lineitem', 'allowed_values(l_returnflag)', COUNT(*) FILTER (l_returnflag NOT IN ('A', 'N'))
            FROM lineitem
        UNION ALL SELECT 'lineitem', 'unique(l_orderkey,l_linenumber)', COUNT(*) FROM ({REPEATED_SQL})
    """,
}
