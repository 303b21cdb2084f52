"""Keys that depend on the row alone, so a rebuild or a retried task gives the same ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column | str) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def row_token(*columns: str) -> Column:
    """64-bit hash of the columns; NULLs count, so (NULL, 1) and (1, NULL) differ."""
    return F.xxhash64(*columns, *[F.isnull(c) for c in columns])


def row_key(*columns: str) -> Column:
    """128-bit key of the columns as 32 hex digits.

    64 bits are not enough to stay unique: at 10^12 rows some 27,000 pairs would collide.
    """
    masks = [F.isnull(c) for c in columns]
    halves = [F.xxhash64(*columns, *masks), F.xxhash64(F.lit(1), *columns, *masks)]
    return F.concat(*[F.lpad(F.hex(half), 16, "0") for half in halves])


def hash_unit(key: Column | str, seed: int = 42) -> Column:
    """A number in [0, 1) drawn from the key and a seed; any engine with md5 can repeat it.

    A missing key draws the number of the empty text, so its row is in a split as well.
    """
    column = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def bucket_of(token: Column, count: Column | int) -> Column:
    """A bucket 0..count-1 from a 64-bit token."""
    size = F.lit(count) if isinstance(count, int) else count
    return F.pmod(token, size.cast("bigint"))


# A prime just below 2^47, and a multiplier whose products with smaller numbers stay below 2^63.
DRAW_MODULUS, DRAW_FACTOR = (1 << 47) - 115, 48271
#: A key jumps about ln(count) times; more jumps than this happen to one key in 10^12 of 10^9 buckets.
MOST_JUMPS = 64
#: Jumps are made in turns of so many; a key that has arrived skips the turns that are left.
JUMPS_A_TURN = 8


def jump_bucket(token: Column, count: Column | int) -> Column:
    """A bucket 0..count-1 that seldom changes with the count: jump consistent hashing.

    Each bucket that is added takes its share of every other one, so from N to N + 1 buckets one key in
    N + 1 moves, all of them to the new bucket. A key's draws follow from its token alone: from bucket b
    it jumps to floor((b + 1) / draw) while that is below the count. NULL without
    buckets or a token.
    """
    size = (F.lit(count) if isinstance(count, int) else count).cast("bigint")
    most, modulus, factor = size.cast("double"), F.lit(float(DRAW_MODULUS)), F.lit(DRAW_FACTOR).cast("bigint")

    def drawn(s: Column) -> Column:
        return s * factor % F.lit(DRAW_MODULUS)

    # `s` is drawn for the jump from `next`, so no draw is worked out twice.
    def jump(state: Column, _: Column) -> Column:
        there = F.floor(F.least((state["next"] + F.lit(1)).cast("double") / (state["s"].cast("double") / modulus), most))
        moved = F.struct(drawn(state["s"]).alias("s"), state["next"].alias("at"), there.alias("next"))
        return F.when(state["next"] < size, moved).otherwise(state)

    def turn(state: Column, _: Column) -> Column:
        further = F.aggregate(F.sequence(F.lit(1), F.lit(JUMPS_A_TURN)), state, jump)
        return F.when(state["next"] < size, further).otherwise(state)

    seed = drawn(F.pmod(token, F.lit(DRAW_MODULUS - 1)) + 1)
    start = F.struct(seed.alias("s"), F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("next"))
    turns = F.sequence(F.lit(1), F.lit(MOST_JUMPS // JUMPS_A_TURN))
    # The bucket is named once: what is named twice is worked out twice.
    bucket = F.aggregate(turns, start, turn, lambda state: F.when(state["at"] >= 0, state["at"]))
    return F.when(token.isNotNull(), bucket)
