"""Time arithmetic that gives the same answer in every session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the transaction source counts seconds from this instant.
SOURCE_EPOCH = "2023-01-01 00:00:00"


def source_timestamp(seconds: Column | str, epoch: str = SOURCE_EPOCH) -> Column:
    """Seconds since `epoch` as a zone-free timestamp."""
    column = F.col(seconds) if isinstance(seconds, str) else seconds
    zero = F.lit(0)
    offset = F.make_dt_interval(zero, zero, zero, column.cast("decimal(18,6)"))
    return F.lit(epoch).cast("timestamp_ntz") + offset


def day_number(day: Column | str) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(day)
