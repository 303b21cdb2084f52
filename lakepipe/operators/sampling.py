"""Splits, samples and class weights that depend on the row key alone.

A row stays on its side when the table is rebuilt, repartitioned or grows, and a retried task
cannot move it, which is not so with row-order sampling.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.functions.keys import hash_unit


def hash_split(df: DataFrame, key: str, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    draw = hash_unit(key, seed)
    return df.filter(draw < train_share), df.filter(draw >= train_share)


def stratified_sample(
    df: DataFrame, key: str, label: str, fractions: Mapping[int, float], seed: int = 42
) -> DataFrame:
    """Keep about `fractions[label]` of each label; a label not named is left out."""
    return stratified_split(df, key, label, fractions, seed)[0]


def stratified_split(
    df: DataFrame, key: str, label: str, fractions: Mapping[int, float], seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(sample, all other rows): about `fractions[label]` of each label, none of a label not named."""
    wanted = F.lit(0.0)
    for value, fraction in fractions.items():
        wanted = F.when(F.col(label) == value, F.lit(float(fraction))).otherwise(wanted)
    draw = hash_unit(key, seed)
    return df.filter(draw < wanted), df.filter(draw >= wanted)


def holdout(df: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """Rows of `df` that are not in `train`, repeated rows included."""
    return df.join(train.select(key), key, "left_anti")


def except_rows(df: DataFrame, other: DataFrame) -> DataFrame:
    """Set difference of whole rows: repeated rows are returned once.

    Both sides lose their copies on the map side, before the rows meet.
    """
    return df.distinct().subtract(other.distinct())


def downsample_majority(
    df: DataFrame, key: str, label: str, negatives_per_positive: float = 3.0, seed: int = 42
) -> DataFrame:
    """All positives and about `negatives_per_positive` times as many negatives."""
    ratio = F.try_divide(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0))
    fraction = df.agg(F.least(F.lit(1.0), ratio * F.lit(negatives_per_positive)).alias("fraction")).scalar()
    positives = df.filter(F.col(label) == 1)
    negatives = df.filter((F.col(label) == 0) & (hash_unit(key, seed) < fraction))
    return positives.unionByName(negatives)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight): rows / (2 * rows of the class), for the labels 0 and 1."""
    counts = df.filter(F.col(label).isin(0, 1)).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(label, F.try_divide(total.cast("double"), F.lit(2.0) * F.col("n")).alias("weight"))


def with_class_weights(df: DataFrame, label: str, weight: str = "class_weight") -> DataFrame:
    """Attach the weight of each row's class; the broadcast side has two rows."""
    weights = class_weights(df, label).withColumnRenamed("weight", weight)
    return df.join(F.broadcast(weights), label)
