"""Parquet writers, and the few file operations that publishing a table needs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


#: Keys of hex digits take half the room, and so do features.
CODEC = "zstd"


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "append", rebalance: bool = True
) -> None:
    """Write into one folder per value of `by`.

    mode "append" adds files. mode "replace" overwrites just the folders present in `df`, so a
    batch can be written again without doubling its rows. Rows are rebalanced first: few files
    per folder, and a folder with very many rows is written by several tasks. Without `rebalance`
    every task writes what it has.
    """
    rows = df.hint("rebalance", *by) if rebalance else df
    writer = rows.write.partitionBy(*by).option("compression", CODEC)
    if mode == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    elif mode == "append":
        writer.mode("append").parquet(path)
    else:
        raise ValueError(f"unknown mode {mode}")


def _located(spark: SparkSession, path: str):
    """(file system, path) on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _located(spark, path)
    return files.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none if it isn't there."""
    files, target = _located(spark, path)
    if not files.exists(target):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(target) if f.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer needed."""
    files, target = _located(spark, path)
    files.delete(target, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the folder it goes to must not be there."""
    files, source = _located(spark, path)
    target = _located(spark, to)[1]
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


# The next version of a table stands beside it until it is complete, the last one until it is replaced.
NEXT, LAST, COMPLETE = ".next", ".last", "_COMPLETE"


def settle(spark: SparkSession, path: str) -> None:
    """Finish or undo a publication of the table that broke off.

    A next version that was written completely takes the table's place; without one, the last
    version goes back where it was.
    """
    following, last = path + NEXT, path + LAST
    if exists(spark, f"{following}/{COMPLETE}"):
        if exists(spark, path):
            remove(spark, last)
            move(spark, path, last)
        move(spark, following, path)
    elif not exists(spark, path) and exists(spark, last):
        move(spark, last, path)
    remove(spark, last)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace the whole table, which `df` may read from.

    The new version is written beside the table and marked as complete; then folders are renamed. A
    write that breaks off leaves the table as it was. One that breaks off between the renames is
    finished by the next reader or writer (see `settle`), so some complete version can always be
    read. Readers in the middle of the old version have to start again; a table has one writer.
    """
    spark = df.sparkSession
    settle(spark, path)
    df.write.mode("overwrite").parquet(path + NEXT)
    files, mark = _located(spark, f"{path}{NEXT}/{COMPLETE}")
    files.create(mark).close()
    settle(spark, path)


def replace_folder(df: DataFrame, path: str, folder: str, rebalance: bool = True) -> None:
    """Make `folder`, one partition of the table at `path`, hold just the rows of `df`; no rows, no folder.

    The rows are written aside first, in a folder that readers of the table don't see. Without `rebalance`
    they aren't shuffled: every task writes what it reads.
    """
    spark, target = df.sparkSession, f"{path}/{folder}"
    aside = f"{path}/_next-{uuid.uuid4().hex}"
    (df.hint("rebalance") if rebalance else df).write.option("compression", CODEC).parquet(aside)
    empty = spark.read.parquet(aside).isEmpty()
    remove(spark, target)
    if not empty:
        move(spark, aside, target)
    remove(spark, aside)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write `df` once and return the written copy, so checks and publishing see the same rows."""
    df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
    return df.sparkSession.read.parquet(path)


def leaf_folders(spark: SparkSession, path: str, depth: int = 2) -> list[str]:
    """The partition folders below a folder, as paths from it; none if it isn't there."""
    names = [n for n in subfolders(spark, path) if "=" in n]
    if depth == 1:
        return names
    return [f"{n}/{below}" for n in names for below in leaf_folders(spark, f"{path}/{n}", depth - 1)]


def publish_folders(spark: SparkSession, staged: str, path: str, replace: bool = True) -> None:
    """Move what is staged into the table at `path`, folder by folder; what was moved before stays moved.

    `replace` puts a staged folder in the place of the table's; without it the staged files are added to
    the table's folder. A publication that breaks off is finished by doing it again.
    """
    for folder in leaf_folders(spark, staged):
        if replace:
            remove(spark, f"{path}/{folder}")
            move(spark, f"{staged}/{folder}", f"{path}/{folder}")
            continue
        files, source = _located(spark, f"{staged}/{folder}")
        target = _located(spark, f"{path}/{folder}")[1]
        files.mkdirs(target)
        for name in [f.getPath().getName() for f in files.listStatus(source)]:
            # File names are unique; one that is there already was copied by a move that broke off.
            to = _located(spark, f"{path}/{folder}/{name}")[1]
            files.delete(to, False)
            if not files.rename(_located(spark, f"{staged}/{folder}/{name}")[1], to):
                raise OSError(f"cannot move {name} to {path}/{folder}")
