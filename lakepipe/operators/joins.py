"""Many-to-one joins that spread a hot key over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A piece of a key holds at most HOT_FLOOR rows, or this share of the table if that is more: the
# list of hot keys has at most 1/HOT_SHARE rows, so it may be broadcast.
HOT_SHARE = 0.00001
HOT_FLOOR = 1_000_000
NULL_SALTS = 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, at_most: int | None = None) -> bool:
    """Whether Spark's own limit lets this table be broadcast.

    `at_most` is a bound on its size the caller knows. Catalyst's estimate can be far too high: it
    takes a join for a product.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= limit or (at_most is not None and at_most <= limit)


def hot_keys(
    counts: DataFrame, keys: Sequence[str], rows: str, share: float = HOT_SHARE, floor: int = HOT_FLOOR
) -> DataFrame:
    """Keys with more than `share` of all rows, and into how many pieces to cut each.

    There can be at most 1/share such keys, whatever the size of the table.
    """
    limit = F.greatest(F.lit(floor), F.ceil(counts.agg(F.sum(rows)).scalar() * F.lit(share)))
    sized = counts.select(*keys, F.col(rows).alias("_rows"), limit.alias("_limit"))
    hot = sized.filter(F.col("_rows") > F.col("_limit"))
    return hot.select(*keys, F.ceil(F.col("_rows") / F.col("_limit")).cast("int").alias("_pieces"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    counts: tuple[DataFrame, str] | None = None,
    share: float = HOT_SHARE,
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """Join where hot keys of `left` are cut into pieces and their `right` rows are repeated.

    The piece of a row is a hash of its `spread` columns, so a retried task puts it in the same
    one. `counts` is a table that already knows the rows per key; without it they are counted.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    keys = list(keys)
    known, rows = counts or (left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "_n")
    # At most 1/share rows, see hot_keys.
    hot = F.broadcast(hot_keys(known, keys, rows, share, floor))

    token = F.xxhash64(*spread)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    piece = F.when(no_key, F.pmod(token, F.lit(NULL_SALTS))).otherwise(
        F.pmod(token, F.coalesce(F.col("_pieces"), F.lit(1)))
    )
    salted_left = left.join(hot, keys, "left").withColumn("_piece", piece.cast("int")).drop("_pieces")
    last = F.coalesce(F.col("_pieces"), F.lit(1)) - 1
    salted_right = (
        right.join(hot, keys, "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), last)))
        .drop("_pieces")
    )
    return salted_left.join(salted_right, [*keys, "_piece"], how).drop("_piece")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    counts: tuple[DataFrame, str] | None = None,
    right_at_most: int | None = None,
) -> DataFrame:
    """Attach `right` (unique on `keys`) to `left`.

    A right side under Spark's broadcast limit needs no shuffle of `left`; a larger one is joined
    by salted_join.
    """
    if fits_broadcast(right, right_at_most):
        return left.join(right, list(keys), how)
    return salted_join(left, right, keys, spread, how, counts)
