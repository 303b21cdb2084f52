"""Removal of repeated rows with a defined survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in `order`.

    Spark limits each map task to one row per key before the shuffle (WindowGroupLimit), so a key
    with very many copies sends at most one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(ranked)).filter("_place = 1").drop("_place")


def keep_first_desc(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in `order`; ties go by the hash of the row."""
    quoted = [f"`{c}`" for c in df.columns]
    ranked = Window.partitionBy(*[f"`{k}`" for k in keys]).orderBy(*[F.desc(c) for c in order], F.xxhash64(*quoted))
    return df.withColumn("_place", F.row_number().over(ranked)).filter("_place = 1").drop("_place")


def not_yet_loaded(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows whose content key is not in `target` yet.

    Only the keys of `target` that `df` has are kept before the rows meet, so a large target is
    read once and, when Spark may broadcast the keys of `df`, not shuffled.
    """
    repeated = target.select(key).join(df.select(key).distinct(), key, "left_semi").distinct()
    return df.join(repeated, key, "left_anti")
