"""Global order without a global sort in one task: running totals, dense ids, top shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakepipe.functions.keys import row_token
from lakepipe.session import checkpoint

ROWS_PER_BLOCK = 2_000_000
COPIES_PER_STEP = 1_000_000


def _with_blocks(df: DataFrame, order: str, blocks: int) -> DataFrame:
    """Add `_block`: which range of `order` a row is in, and write the table once.

    Spark draws the cut points from a sample of each partition. Any cut points give the right
    totals; they have to be the same for both uses of the table, which the written copy sees to.
    """
    if blocks <= 1:
        return df.withColumn("_block", F.lit(0))
    return checkpoint(df.repartitionByRange(blocks, order).withColumn("_block", F.spark_partition_id()))


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    *,
    descending: bool = False,
    ties: Sequence[str] = (),
    blocks: int | None = None,
) -> DataFrame:
    """Add `cum_<c>`: the total of `c` over all rows up to this one in the order of `order`.

    `order` is (nearly) unique: group by it first. The table is cut into ranges of about
    ROWS_PER_BLOCK rows; each range is summed by itself and starts from the total of the ranges
    before it, so no task sorts more than one range at a time. The broadcast side has one row per
    range: 500,000 for 10^12 rows.
    """
    if blocks is None:
        blocks = -(-df.count() // ROWS_PER_BLOCK)
    blocked = _with_blocks(df, order, blocks)
    direction = F.desc if descending else F.asc
    within = (
        Window.partitionBy("_block")
        .orderBy(direction(order), *[direction(t) for t in ties])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    if blocks <= 1:
        return blocked.withColumns({f"cum_{c}": F.sum(c).over(within) for c in sums}).drop("_block")

    earlier = Window.orderBy(direction("_block")).rowsBetween(Window.unboundedPreceding, -1)
    per_block = blocked.groupBy("_block").agg(*[F.sum(c).alias(c) for c in sums])
    starts = per_block.select(
        "_block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_start_{c}") for c in sums]
    )
    totals = {f"cum_{c}": F.col(f"_start_{c}") + F.sum(c).over(within) for c in sums}
    joined = blocked.join(F.broadcast(starts), "_block")
    return joined.withColumns(totals).drop("_block", *[f"_start_{c}" for c in sums])


def dense_ids(df: DataFrame, key: str, id_col: str, start: int = 0, blocks: int | None = None) -> DataFrame:
    """Number the rows start, start+1, ... without gaps; `key` is unique.

    A numeric key sets the order. Any other key is numbered in the order of its hash.
    """
    if isinstance(df.schema[key].dataType, T.NumericType):
        order, ties, source = key, [], df
    else:
        order, ties, source = "_token", [key], df.withColumn("_token", row_token(key))
    counted = running_totals(source.withColumn("_one", F.lit(1)), order, ["_one"], ties=ties, blocks=blocks)
    numbered = counted.withColumn(id_col, (F.col("cum__one") - 1 + F.lit(start)).cast("bigint"))
    return numbered.drop("_one", "cum__one", "_token")


def dense_row_ids(
    df: DataFrame, id_col: str, blocks: int | None = None, copies_per_step: int = COPIES_PER_STEP
) -> DataFrame:
    """Number the rows of a table without a key 0..N-1; equal rows get different ids.

    Equal rows are counted, the distinct rows are numbered by running totals, and the copies are
    written out again. A row with very many copies is first cut into pieces for different tasks.
    """
    columns = df.columns
    quoted = [f"`{c}`" for c in columns]
    distinct = df.groupBy(*quoted).agg(F.count(F.lit(1)).alias("_copies"))
    distinct = checkpoint(distinct.withColumn("_token", row_token(*quoted)))
    spans = running_totals(distinct, "_token", ["_copies"], ties=quoted, blocks=blocks).withColumns(
        {"_last": F.col("cum__copies") - 1, "_first": F.col("cum__copies") - F.col("_copies")}
    )
    small = spans.filter(F.col("_copies") <= copies_per_step)
    large = (
        spans.filter(F.col("_copies") > copies_per_step)
        .withColumn("_first", F.explode(F.sequence("_first", "_last", F.lit(copies_per_step).cast("bigint"))))
        .withColumn("_last", F.least(F.col("_last"), F.col("_first") + F.lit(copies_per_step - 1)))
        .repartition("_first")
    )
    pieces = small.unionByName(large)
    return pieces.select(*quoted, F.explode(F.sequence("_first", "_last")).alias(id_col))


def score_counts(df: DataFrame, score: str) -> DataFrame:
    """(score, n, cum_n): rows at each score, and at it or above."""
    counts = checkpoint(df.groupBy(F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("n")))
    return running_totals(counts, "score", ["n"], descending=True)


def top_share(df: DataFrame, score: str, key: str, share: float, counts: DataFrame | None = None) -> DataFrame:
    """The int(rows * share) rows with the highest score; rows of equal score go by `key`.

    The cut is found on the counts per score (`counts` hands over known ones). Only the rows
    exactly on it need ranking, and that is done by running totals, so neither a large n nor a
    huge tie ends up in one task.
    """
    counts = score_counts(df, score) if counts is None else counts
    rows = counts.agg(F.max("cum_n")).first()[0] or 0
    wanted = int(rows * share)
    if wanted == 0:
        return df.limit(0)
    edge = counts.filter(F.col("cum_n") >= wanted).orderBy(F.desc("score")).first()
    cut, missing = edge["score"], wanted - (edge["cum_n"] - edge["n"])
    above, tied = df.filter(F.col(score) > F.lit(cut)), df.filter(F.col(score) == F.lit(cut))
    if missing < edge["n"]:
        tied = dense_ids(tied, key, "_rank").filter(F.col("_rank") < missing).drop("_rank")
    return above.unionByName(tied)
