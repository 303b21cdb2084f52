"""Reading the given tables and small helpers over DataFrames."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A bounded sample is drawn from at most so many groups, the largest ones.
MOST_GROUPS = 4096

_ROOT = str(Path(__file__).resolve().parents[2])

# The letters that lower-casing changes.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Let Python workers on machines that have this folder import the package.

    A cluster whose machines don't have it is given the package with --py-files.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name like `wanted` that the table doesn't have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def quoted(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts without other letters take the faster way."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 4; a missing id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 2


def bounded_sample(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """(group, key, text_hash) of up to `most` different documents of each group, those with the smallest draws.

    `rows` has the columns group, key and text_hash. The draw is a hash of key and text, so rows
    without a key, or with the same one, are drawn one by one; rows that agree in both count once.
    Counts come first: only about twice the wanted rows of a group pass a threshold on the draw. Those
    that agree are merged before the shuffle, so few rows meet in one task to be ranked, whatever the
    size of the table and however many rows are alike. Fewer than `most` may be drawn where many are.
    """
    own = [group, key, "text_hash"]
    draw = F.shiftrightunsigned(F.xxhash64(F.isnull(key), key, "text_hash"), 11) / F.lit(float(1 << 53))
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), group).limit(MOST_GROUPS)
    # At most MOST_GROUPS rows.
    near = rows.select(*own, draw.alias("_draw")).join(F.broadcast(counts), group)
    near = near.filter(F.col("_draw") * F.col("_n") <= 2.0 * most + 100).select(*own, "_draw").distinct()
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_draw", key, "text_hash"))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_draw", "_rank")


def texts_of(rows: DataFrame, chosen: DataFrame, *also: str) -> DataFrame:
    """The text of every chosen (key, text_hash), once however many rows of (key, text_hash, text) have it.

    `chosen` is broadcast: it comes from `bounded_sample`. Columns `also` of it are kept.
    """
    picked = chosen.select(F.struct("key", "text_hash").alias("_chosen"), *also)
    same = F.col("key").eqNullSafe(F.col("_chosen.key")) & (F.col("text_hash") == F.col("_chosen.text_hash"))
    met = rows.select("key", "text_hash", "text").join(F.broadcast(picked), same)
    return met.groupBy("_chosen", *also).agg(F.min("text").alias("text")).drop("_chosen")
