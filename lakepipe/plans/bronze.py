"""Raw files to Bronze tables."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.sources.readers import BAD_RECORD, read_csv
from lakepipe.sources.writers import replace_folder

BATCH = "batch_id"
BATCH_COLUMNS = ["ingest_date", BATCH]

# The columns of the transaction source.
FEATURE_COLUMNS = [f"V{i}" for i in range(1, 29)]

TRANSACTION_SOURCE = T.StructType(
    [
        T.StructField("Time", T.DoubleType()),
        *[T.StructField(c, T.DoubleType()) for c in FEATURE_COLUMNS],
        T.StructField("Amount", T.DoubleType()),
        T.StructField("Class", T.IntegerType()),
    ]
)


#: What Bronze transactions have besides: types of the folder names, so that none is guessed.
BRONZE_TRANSACTIONS = T.StructType(
    [*TRANSACTION_SOURCE.fields, T.StructField("ingest_date", T.DateType()), T.StructField(BATCH, T.StringType())]
)


def stamp_ingest(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Add `ingest_date`: today, or a given day when a load is repeated."""
    return df.withColumn("ingest_date", F.current_date() if as_of is None else F.lit(as_of).cast("date"))


def batch_of(files: list[str], as_of: str) -> str:
    """The name of the batch that some source files form on a day."""
    return hashlib.md5("\n".join([as_of, *sorted(files)]).encode()).hexdigest()


def rejected(path: str) -> str:
    """Where a Bronze table keeps the rows that don't parse."""
    return f"{path}_rejected"


def ingest_dataset(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    delimiter: str = ",",
    schema: T.StructType | None = None,
    as_of: str | None = None,
    batch: str | None = None,
) -> str:
    """Load CSV files into a Bronze table as one batch; returns the batch's name.

    The table is partitioned by ingest date and batch. A batch is named after its files and its day,
    unless `batch` names it. The same batch of the same day replaces what it held, rejected rows
    included, also when nothing is left of them; any other batch is added, so nothing is lost and
    nothing doubles. With a schema, rows that don't parse go to a table of their own, with their text.
    """
    day = as_of or str(spark.sql("SELECT current_date()").first()[0])
    raw = read_csv(spark, source_path, schema, delimiter, keep_bad_records=schema is not None)
    batch = batch or batch_of(raw.inputFiles(), day)
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"a batch is named with letters, digits, dots, dashes and underscores, not {batch!r}")
    folder = f"ingest_date={day}/{BATCH}={batch}"
    rows = raw
    if schema is not None:
        # The parser fills the text of a bad row only where other columns are read with it.
        bad = F.col(BAD_RECORD).isNotNull()
        seen = Observation()
        rows = raw.observe(seen, F.count_if(bad).alias("bad")).filter(~bad).drop(BAD_RECORD)
    # Nearly all that is read is written, and Spark packs small files into splits already.
    replace_folder(rows, target_path, folder, rebalance=False)
    if schema is not None:
        # Files are parsed again only where a row was bad.
        wrong = raw.filter(bad) if seen.get["bad"] else spark.createDataFrame([], raw.schema)
        replace_folder(wrong, rejected(target_path), folder)
    return batch
