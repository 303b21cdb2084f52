"""Data-quality rules, reported as a table (table_name, rule, violations)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions.money import finer_than


class QualityError(Exception):
    """At least one rule is violated."""


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"not_null({self.column})"

    def violations(self) -> Column:
        return F.count_if(F.col(self.column).isNull())


@dataclass(frozen=True)
class AllowedValues:
    """`nulls_pass` keeps the SQL reading, where NULL NOT IN (...) is unknown and so no violation."""

    column: str
    values: tuple
    nulls_pass: bool = False

    @property
    def name(self) -> str:
        return f"allowed_values({self.column})"

    def violations(self) -> Column:
        outside = ~F.col(self.column).isin(*self.values)
        if not self.nulls_pass:
            outside = outside | F.col(self.column).isNull()
        return F.count_if(outside)


@dataclass(frozen=True)
class FinerThan:
    """Amounts with more places than exact sums keep."""

    column: str

    @property
    def name(self) -> str:
        return f"finer_than_sums({self.column})"

    def violations(self) -> Column:
        return F.count_if(finer_than(self.column))


@dataclass(frozen=True)
class NotEmpty:
    @property
    def name(self) -> str:
        return "not_empty"

    def violations(self) -> Column:
        return F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)


@dataclass(frozen=True)
class HasSchema:
    """Every expected column is there with the expected type."""

    expected: T.StructType

    @property
    def name(self) -> str:
        return "schema"

    def missing(self, df: DataFrame) -> int:
        actual = {f.name: f.dataType for f in df.schema.fields}
        return sum(actual.get(f.name) != f.dataType for f in self.expected.fields)


@dataclass(frozen=True)
class UniqueKey:
    """Violations are the keys that occur more than once."""

    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"unique({','.join(self.columns)})"


def repeated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter(F.col("copies") > 1)


def quality_report(df: DataFrame, table_name: str, rules: Sequence) -> DataFrame:
    """All row rules in one pass; each unique-key rule is one aggregation of its key columns."""

    def labelled(rule_name: str | Column, count: Column) -> list[Column]:
        name = F.lit(rule_name) if isinstance(rule_name, str) else rule_name
        return [F.lit(table_name).alias("table_name"), name.alias("rule"), count.cast("bigint").alias("violations")]

    row_rules = [r for r in rules if not isinstance(r, UniqueKey)]
    parts = []
    if row_rules:
        counts = [
            (F.max(F.lit(r.missing(df))) if isinstance(r, HasSchema) else r.violations()) for r in row_rules
        ]
        entries = [
            F.struct(F.lit(r.name).alias("rule"), F.coalesce(c, F.lit(0)).cast("bigint").alias("n"))
            for r, c in zip(row_rules, counts)
        ]
        one_row = df.agg(F.array(*entries).alias("entries"))
        parts.append(one_row.select(F.explode("entries").alias("e")).select(*labelled(F.col("e.rule"), F.col("e.n"))))
    for rule in rules:
        if isinstance(rule, UniqueKey):
            repeated = repeated_keys(df, rule.columns)
            parts.append(repeated.agg(F.count(F.lit(1)).alias("n")).select(*labelled(rule.name, F.col("n"))))
    return reduce(DataFrame.unionByName, parts)


class WatchedRules:
    """Rules checked while rows are written: row rules are counted by the write itself.

    Write `rows`, then call `require_clean` with what was written; a unique-key rule reads only its
    key columns again.
    """

    def __init__(self, df: DataFrame, table_name: str, rules: Sequence):
        self.table_name = table_name
        self.unique = [r for r in rules if isinstance(r, UniqueKey)]
        self.watched = [r for r in rules if not isinstance(r, UniqueKey)]
        self.observation = Observation()
        counts = [
            F.coalesce(F.max(F.lit(r.missing(df))) if isinstance(r, HasSchema) else r.violations(), F.lit(0))
            for r in self.watched
        ]
        named = [c.cast("bigint").alias(r.name) for r, c in zip(self.watched, counts)]
        self.rows = df.observe(self.observation, *named) if named else df

    def require_clean(self, written: DataFrame) -> None:
        """Raise when a rule is violated; the write must be over."""
        counts = self.observation.get if self.watched else {}
        broken = [(rule.name, counts[rule.name]) for rule in self.watched if counts[rule.name]]
        if broken:
            raise QualityError("; ".join(f"{self.table_name}: {name} violated {n} times" for name, n in broken))
        if self.unique:
            require_clean(quality_report(written, self.table_name, self.unique))


def availability_report(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Whether each table of {name: path} is there and has rows; looks at one row of each."""

    def missing(path: str) -> int:
        try:
            return int(spark.read.parquet(path).isEmpty())
        except AnalysisException:
            return 1

    rows = [(name, "available", missing(path)) for name, path in paths.items()]
    return spark.createDataFrame(rows, "table_name string, rule string, violations bigint")


def require_clean(report: DataFrame) -> None:
    """Raise when a rule is violated; a report has one row per rule."""
    broken = report.filter("violations > 0").collect()
    if broken:
        raise QualityError("; ".join(f"{r.table_name}: {r.rule} violated {r.violations} times" for r in broken))


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no row in the dimension."""
    return fact.join(dimension.select(key), key, "left_anti")
