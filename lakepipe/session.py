"""Session settings and the shared folder that intermediate results may use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "lakepipe", master: str | None = None, **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution; `settings` overrides or adds any Spark setting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # A join whose smaller side has only small partitions needs no sort.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        # A checkpoint goes when nothing uses it any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for name, value in {**defaults, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: the session's checkpoint folder.

    It comes from `spark.checkpoint.dir`. A session without that setting uses a folder of its
    warehouse (`spark.sql.warehouse.dir`), which its executors share as well; on a cluster that may
    not be a folder of one machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            configured = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
            if configured.startswith("file:") and not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, every query's shuffle files are deleted when it ends, not when the driver collects its objects.

    For queries whose result is written: nothing reads their shuffles again.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


HUGE_METHOD, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


@contextmanager
def methods_compiled(spark: SparkSession) -> Iterator[None]:
    """Inside, a stage whose code HotSpot would only interpret, as a method beyond its limit, is cut into operators.

    For queries over many columns.
    """
    before = spark.conf.get(HUGE_METHOD)
    spark.conf.set(HUGE_METHOD, COMPILED_BYTES)
    try:
        yield
    finally:
        spark.conf.set(HUGE_METHOD, before)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder once and continue from the written copy."""
    shared_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        return df.checkpoint(eager=True)
