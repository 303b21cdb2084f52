"""Exact deduplication with a heavy-hitter split.

Texts are compared by the SHA-256 digest of their normalised form (A-Z lower-cased, null as empty).
Misra-Gries summaries, one per task, find every digest that may hold more than 2/COUNTERS of all
rows. There are at most COUNTERS of them, whatever the table; their exact counts and winners come
from one map-side aggregation and are broadcast, so the rows of large groups are decided where they
are. The remaining digests have groups of at most 2/COUNTERS of the rows and are shuffled by digest.

Of equal texts the row with the largest key stays; a null key is smaller than any other. Rows that
agree in key and text are interchangeable: exactly one of them is marked kept, and `keep_unique`
keeps one of them. Empty and null texts are equal to each other. An empty table gives an empty
result. Other columns play no role and may have any names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakepipe.llm.frames import ascii_lower, fresh_name, quoted, ship, table
from lakepipe.session import checkpoint

COUNTERS = 4096
#: Up to so many decisions (40 bytes each, and what a hash table adds) are broadcast to the texts; more are shuffled with them.
BROADCAST_ROWS = 1_000_000


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))


def _shrink(counts: Counter, size: int) -> Counter:
    """Misra-Gries on a merged summary: take the (size+1)-th largest count off every one."""
    if len(counts) <= size:
        return counts
    cut = sorted(counts.values(), reverse=True)[size]
    return Counter({k: n - cut for k, n in counts.items() if n > cut})


def misra_gries(rows: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """(column, low) of at most `counters` values, among them each with over 2/counters of the rows.

    A task's summary undercounts by at most its rows / counters, so the summed counts undercount by
    at most all rows / counters. Counts of at least that much are kept; they sum to no more than
    all rows.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()
        for batch in batches:
            kept.update(batch.column(0).to_pylist())
            kept = _shrink(kept, counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(kept), pa.binary()), pa.array(list(kept.values()), pa.int64())], [column, "low"]
        )

    ship(rows.sparkSession)
    summaries = rows.select(column).mapInArrow(summarise, f"{column} binary, low bigint")
    total = rows.agg((F.count(F.lit(1)) / counters).alias("least"))
    return summaries.groupBy(column).agg(F.sum("low").alias("low")).filter(F.col("low") >= total.scalar())


def decide(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: key, digest, keep_id, group_size, kept."""
    rows = docs.select(quoted(key).alias("key"), digest(quoted(text)).alias("digest"))
    rows = checkpoint(rows.withColumn("row", F.monotonically_increasing_id()))
    winner = F.max(F.struct("key", "row")).alias("winner")
    # At most `counters` rows, see misra_gries.
    suspects = checkpoint(misra_gries(rows, "digest", counters).select("digest"))
    heavy = checkpoint(
        rows.join(F.broadcast(suspects), "digest").groupBy("digest").agg(winner, F.count(F.lit(1)).alias("n"))
    )

    decided = rows.join(F.broadcast(heavy), "digest", "left")
    group = Window.partitionBy("digest")
    light = (
        decided.filter(F.col("n").isNull())
        .select("key", "digest", "row")
        .withColumns({"winner": F.max(F.struct("key", "row")).over(group), "n": F.count(F.lit(1)).over(group)})
    )
    both = decided.filter(F.col("n").isNotNull()).select(light.columns).unionByName(light)
    return both.select(
        "key",
        "digest",
        F.col("winner.key").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("winner.row") == F.col("row")).alias("kept"),
    )


def keep_unique(docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    mark, other = fresh_name(docs, "_digest"), fresh_name(docs, "_decision")
    decisions = checkpoint(
        decide(docs, key, text, counters)
        .groupBy("key", "digest")
        .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("copies"))
        .filter(~F.col("kept") | (F.col("copies") > 1))
        .select(F.struct("key", "digest").alias(other), "kept")
    )
    marked = docs.withColumn(mark, digest(quoted(text)))
    same = quoted(key).eqNullSafe(F.col(f"{other}.key")) & (F.col(mark) == F.col(f"{other}.digest"))

    def narrow(rows: DataFrame) -> DataFrame:
        few = rows.count() <= BROADCAST_ROWS
        return F.broadcast(rows.select(other)) if few else rows.select(other)

    once = marked.join(narrow(decisions), same, "left_anti")
    # Rows that agree in key and text: one of them stays.
    repeated = decisions.filter("kept")
    if not repeated.isEmpty():
        found = marked.join(narrow(repeated), same, "left_semi").dropDuplicates([key, mark])
        once = once.unionByName(found)
    return once.drop(mark)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions = decide(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return decisions.select(
        F.col("key").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


QUERIES = {"op5_exact_dedup": op5_exact_dedup}
ORACLE = {
    "op5_exact_dedup": """
        WITH t AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)
    """
}
