"""Sharding by a permutation-filled lookup table (Maglev hashing; Eisenbud et al., 2016).

The table has a prime number of slots. Every shard has its own order of preference over them,

    slot(j) = (offset + j * skip) mod size,

which visits every slot once because the size is prime. Shards take turns; each claims the first
slot of its order that is still free, until none is left. So every shard owns nearly the same number
of slots, and when a shard goes or comes, most slots keep their owner. A row's slot is a hash of its
key modulo the size, so placing a row is one look-up; the table has `size` rows of two numbers
whatever the data, and is broadcast.

Defined results: rows are placed by key alone, so repeated rows share a shard; a null key is placed
like an empty one. Text and other columns play no role; columns that have the names of the results
are replaced. A table without rows gives none. At least one shard is needed, and at most as many as
there are slots; names must differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.frames import fresh_name, quoted, table

SLOTS = 65_537
SHARDS = 64


def shard_names(count: int) -> tuple[str, ...]:
    return tuple(f"shard-{i:05d}" for i in range(count))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


@lru_cache(maxsize=8)
def lookup_table(shards: tuple[str, ...], slots: int = SLOTS) -> tuple[int, ...]:
    """The shard number of every slot."""
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("shards need different names, and no more of them than slots")
    if any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    place = [_number(f"offset:{s}") % slots for s in shards]
    skip = [_number(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    owner, left = [-1] * slots, slots
    while left:
        for i in range(len(shards)):
            while owner[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % slots
            owner[place[i]] = i
            left -= 1
            if not left:
                break
    return tuple(owner)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """A key's slot; any engine with md5 can repeat it."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def table_rows(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The lookup table as (slot, shard)."""
    owners = F.split(F.lit(",".join(map(str, lookup_table(tuple(shards), slots)))), ",")
    return spark.range(1).select(F.posexplode(owners).alias("slot", "shard")).select("slot", F.col("shard").cast("int"))


def place(
    df: DataFrame,
    shards: Sequence[str],
    key: str = "doc_id",
    slots: int = SLOTS,
    into: tuple[str, str] = ("slot", "shard"),
) -> DataFrame:
    """Add the slot and the shard number of every row."""
    slot, mine, owner = (fresh_name(df, c) for c in ("_slot", "_table_slot", "_owner"))
    owners = table_rows(df.sparkSession, shards, slots).select(F.col("slot").alias(mine), F.col("shard").alias(owner))
    # `slots` rows of two numbers, see above.
    placed = df.withColumn(slot, slot_of(quoted(key), slots)).join(F.broadcast(owners), F.col(slot) == F.col(mine))
    return placed.withColumns({into[0]: F.col(slot), into[1]: F.col(owner)}).drop(slot, mine, owner)


def moved(df: DataFrame, before: Sequence[str], after: Sequence[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """(key, from_shard, to_shard) by name, of the rows that change their shard when the shards change."""
    names = [F.array(*[F.lit(s) for s in shards]) for shards in (before, after)]
    rows = place(df.select(quoted(key).alias("key")), before, "key", slots, ("slot", "a"))
    rows = place(rows, after, "key", slots, ("slot", "b"))
    shard = [F.element_at(n, F.col(c) + 1) for n, c in zip(names, "ab")]
    return rows.select("key", shard[0].alias("from_shard"), shard[1].alias("to_shard")).filter("from_shard <> to_shard")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return place(docs, shard_names(SHARDS)).select("doc_id", "slot", "shard")


def _oracle() -> str:
    owners = ",".join(map(str, lookup_table(shard_names(SHARDS), SLOTS)))
    return f"""
        WITH t AS (SELECT string_split('{owners}', ',') AS owners),
        d AS (SELECT doc_id, CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT % {SLOTS} AS INT) AS slot
              FROM documents)
        SELECT doc_id, slot, CAST(owners[slot + 1] AS INT) AS shard FROM d, t
    """


QUERIES = {"op8_sharding": op8_sharding}
ORACLE = {"op8_sharding": _oracle()}
