"""Sums of double amounts that do not depend on the order of addition.

A double sum changes in its last digits with the partitioning, so two runs of one job disagree and
values derived from it (ratios, splits, models) drift. Here an amount becomes a decimal number with
SCALE places, decimals are added, and the total becomes a double once. Totals have 38 digits: with
nine places a group may hold 10^29. Amounts with more places than that are counted by the quality
rule FinerThan, and an amount that is not a number, or a total beyond 38 digits, raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRECISION, SCALE = 28, 9


def exact(amount: Column | str) -> Column:
    """An amount as a decimal number; its shortest decimal form counts, as it is written in a source."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return column.cast(f"decimal({PRECISION},{SCALE})")


def finer_than(amount: Column | str) -> Column:
    """Whether an amount has more places than sums keep."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return exact(column).cast("double") != column.cast("double")


def exact_sum(amount: Column | str) -> Column:
    return F.sum(exact(amount)).cast("double")


def exact_avg(amount: Column | str) -> Column:
    return F.try_divide(exact_sum(amount), F.count(amount))


def rate(part: Column | str, whole: Column | str, places: int = 4) -> Column:
    """part / whole rounded half up; NULL where `whole` is zero."""
    return F.round(F.try_divide(part, whole), places)
