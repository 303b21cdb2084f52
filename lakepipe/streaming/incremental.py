"""Incremental loads where Spark's checkpoint, not a date, remembers what was read.

A high mark of day grain never sees a second file of the same day. The file source remembers
files, so such a file is read by the next run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakepipe.layout import Layout
from lakepipe.plans.bronze import BATCH, BRONZE_TRANSACTIONS
from lakepipe.plans.silver import finish_loads, load_batch
from lakepipe.sources.readers import read_or_empty
from lakepipe.sources.state import noted_batches, pending_batches
from lakepipe.sources.writers import write_partitioned

BATCH_COLUMN = "batch_id"


def start_incremental_load(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    target_path: str,
    checkpoint_path: str,
    partition_by: Sequence[str] = (),
    max_files: int | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Process all Parquet files not seen yet, then stop.

    Each micro-batch replaces its own `batch_id` folders, so a batch that is repeated after a
    failure does not double its rows. `check` may raise to keep a batch out.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def publish(batch: DataFrame, batch_id: int) -> None:
        result = transform(batch).withColumn(BATCH_COLUMN, F.lit(batch_id).cast("bigint"))
        if check is not None:
            result = result.persist()
            check(result)
        write_partitioned(result, target_path, [BATCH_COLUMN, *partition_by], mode="replace")
        if check is not None:
            result.unpersist()

    return (
        reader.parquet(source_path)
        .writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def start_silver_load(
    spark: SparkSession, layout: Layout, checkpoint_path: str, max_files: int | None = None
) -> StreamingQuery:
    """Bronze transactions not seen yet to Silver, by the steps of the batch load and into the same folders.

    New files tell that batches wait; a batch is always loaded as a whole, so neither the size of
    micro-batches nor a new checkpoint changes which transactions Silver holds. A batch is loaded once
    for each time that it was noted as ingested, or whenever files of it come if it never was. Batches
    that were corrected to nothing have no new files and are loaded at the start.
    """

    def publish(files: DataFrame, _: int) -> None:
        finish_loads(spark, layout)
        waiting = pending_batches(spark, layout.batches, "transactions")
        noted = noted_batches(spark, layout.batches, "transactions", "ingested")
        seen = sorted(r[BATCH] for r in files.select(BATCH).distinct().collect())
        for batch in [*waiting, *[b for b in seen if b not in noted]]:
            load_batch(spark, layout, batch)

    finish_loads(spark, layout)
    bronze = read_or_empty(spark, layout.bronze("transactions"), BRONZE_TRANSACTIONS)
    for batch in pending_batches(spark, layout.batches, "transactions"):
        if bronze.filter(F.col(BATCH) == batch).isEmpty():
            load_batch(spark, layout, batch)
    reader = spark.readStream.schema(BRONZE_TRANSACTIONS)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        # Only the names of batches are asked of the files; all columns would be read otherwise.
        reader.parquet(layout.bronze("transactions"))
        .select(BATCH)
        .writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


@dataclass(frozen=True)
class DedupRun:
    """What a run of the stateful load did: late rows are those older than the watermark, which it left out."""

    rows_in: int
    late_rows: int


#: State that doesn't fit into an executor's memory goes to its disk.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def load_distinct(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    keys: Sequence[str],
    event_time: str,
    horizon: str,
    target_path: str,
    checkpoint_path: str,
    partition_by: Sequence[str] = (),
    max_files: int | None = None,
) -> DedupRun:
    """Append the rows of new Parquet files whose keys were not seen within the horizon, then stop.

    For streams too long to keep every key: the state store has a key until the watermark, which
    follows `event_time` at the distance `horizon`, has passed the key's first row by the horizon. A copy
    that comes within it is dropped; of copies in one micro-batch any may stay. A row older than the
    watermark could be a copy of a key that is forgotten; it is left out and counted. The sink's log
    knows which micro-batches it holds, so one that is repeated adds nothing.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    distinct = reader.parquet(source_path).withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(keys))
    writer = distinct.writeStream.outputMode("append").option("checkpointLocation", checkpoint_path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        query = writer.trigger(availableNow=True).format("parquet").start(target_path)
    finally:
        spark.conf.set(STATE_STORE, before)
    # The query itself only remembers its last hundred micro-batches.
    done, ended = {}, False
    while not ended:
        ended = query.awaitTermination(1)
        for progress in query.recentProgress:
            late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
            done[progress.batchId] = (progress.numInputRows, late)
    return DedupRun(sum(n for n, _ in done.values()), sum(late for _, late in done.values()))
