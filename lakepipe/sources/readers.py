"""CSV and Parquet readers and the generated calendar range."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.sources.writers import exists, settle

BAD_RECORD = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    delimiter: str = ",",
    keep_bad_records: bool = False,
) -> DataFrame:
    """CSV files with a header; quotes inside quoted values are doubled.

    With a schema the files are read once and the header must match it. `keep_bad_records` adds
    the text of rows that do not parse as `_corrupt_record`. Without a schema the types are
    inferred, which reads everything twice.
    """
    reader = spark.read.option("header", True).option("sep", delimiter).option("quote", '"').option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if keep_bad_records:
        schema = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def _found(error: AnalysisException) -> bool:
    return error.getCondition() != "PATH_NOT_FOUND"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; partition columns come back from the folder names.

    A table that is gone because its publication broke off is put back first.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if _found(error):
            raise
        settle(spark, path)
        return spark.read.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A Parquet table of a known schema, without rows while it isn't there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if _found(error):
            raise
        settle(spark, path)
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def newer_than(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows with `column` after the mark; everything when there is no mark.

    The mark is cast to the type of the column, so on a partition column this stays a partition
    filter and old folders are not opened.
    """
    if mark is None:
        return df
    return df.filter(F.col(column) > F.lit(mark).cast(df.schema[column].dataType))


def date_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("a"), F.lit(last).cast("date").alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b")).alias("full_date"))


def date_range_of(df: DataFrame, column: str) -> DataFrame:
    """One row per day from the earliest to the latest day in `column`."""
    bounds = df.agg(F.to_date(F.min(column)).alias("a"), F.to_date(F.max(column)).alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b")).alias("full_date"))
