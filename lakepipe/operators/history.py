"""History-keeping (type 2) merge of a dimension with a new snapshot of its source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.operators.ordering import dense_ids
from lakepipe.session import checkpoint

HISTORY_COLUMNS = ("valid_from", "valid_to", "is_current")


def merge_history(
    dimension: DataFrame,
    snapshot: DataFrame,
    key: str,
    surrogate: str,
    as_of: str,
    close_missing: bool = True,
) -> DataFrame:
    """The dimension after `snapshot`, whose rows are unique on `key`.

    A changed row ends on `as_of` and a new version starts there; a new key gets its first
    version; a key missing from the snapshot ends (unless `close_missing` is off); the rest and
    all closed versions stay. Applying the same snapshot twice changes nothing. New versions get
    the surrogate keys after the highest one in use.
    """
    attributes = [c for c in snapshot.columns if c != key]
    day = F.lit(as_of).cast("date")
    current = dimension.filter("is_current = 1")
    old = current.select(key, F.struct(*dimension.columns).alias("old"))
    new = snapshot.select(key, F.struct(key, *attributes).alias("new"))
    pairs = checkpoint(old.join(new, key, "full_outer"))

    is_old, is_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    differences = [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in attributes]
    changed = is_old & is_new & reduce(lambda a, b: a | b, differences, F.lit(False))
    ended = changed | (is_old & ~is_new) if close_missing else changed

    kept = (
        pairs.filter(is_old)
        .select("old.*", ended.alias("_ended"))
        .withColumn("valid_to", F.when(F.col("_ended"), day).otherwise(F.col("valid_to")))
        .withColumn("is_current", F.when(F.col("_ended"), 0).otherwise(F.col("is_current")))
        .select(*dimension.columns)
    )
    highest = dimension.agg(F.max(surrogate)).first()[0]
    started = pairs.filter(is_new & (~is_old | changed)).select("new.*")
    started = (
        dense_ids(started, key, surrogate, start=0 if highest is None else highest + 1)
        .withColumn("valid_from", day)
        .withColumn("valid_to", F.lit(None).cast("date"))
        .withColumn("is_current", F.lit(1))
        .select(*dimension.columns)
    )
    closed = dimension.filter("is_current <> 1")
    return closed.unionByName(kept).unionByName(started)
