"""Assertions about data as one table of (check, value, severity, ok), profiles, bands and regressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def filled(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")) != "", F.lit(False))


def completeness(df: DataFrame) -> DataFrame:
    """(column, rows, filled, percent) of every column, by one aggregation. Percent is NULL for an empty table."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(filled(F.col(f"`{c}`"))).alias(f"f{i}") for i, c in enumerate(df.columns)])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col("_n").alias("rows"), F.col(f"f{i}").alias("filled")) for i, c in enumerate(df.columns)])
    return counts.select(F.explode(entries).alias("e")).select("e.column", "e.rows", "e.filled", F.round(100 * F.try_divide("e.filled", "e.rows"), 2).alias("percent"))


def value_counts(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The ``k`` most frequent values, ties by value."""
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(k)


def checks(df: DataFrame, table: str, rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """One row for each rule: how many rows break it. ``rules`` gives the condition that must hold and its severity.

    A rule that is NULL for a row isn't broken by it. All rules of a table are one scan and one aggregation.
    """
    counts = df.agg(*[F.count_if(~rule).alias(f"r{i}") for i, (rule, _) in enumerate(rules.values())])
    entries = F.array(*[F.struct(F.lit(f"{table}.{name}").alias("check"), F.col(f"r{i}").alias("value"), F.lit(severity).alias("severity")) for i, (name, (_, severity)) in enumerate(rules.items())])
    return counts.select(F.explode(entries).alias("e")).select("e.check", "e.value", "e.severity", (F.col("e.value") == 0).alias("ok"))


def uniqueness(df: DataFrame, table: str, keys: list[str], severity: str = "FAIL") -> DataFrame:
    """How many keys occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.count(F.lit(1)).alias("value"))
    return repeated.select(F.lit(f"{table}.unique_{'_'.join(keys)}").alias("check"), "value", F.lit(severity).alias("severity"), (F.col("value") == 0).alias("ok"))


def orphans(df: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str, severity: str = "FAIL") -> DataFrame:
    """How many rows point to a parent that isn't there; a NULL pointer points nowhere."""
    lost = df.filter(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti").agg(F.count(F.lit(1)).alias("value"))
    return lost.select(F.lit(f"{table}.orphan_{key}").alias("check"), "value", F.lit(severity).alias("severity"), (F.col("value") == 0).alias("ok"))


def report(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def bands(values: DataFrame, name: str, value: str, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Whether each named value lies inside its band; names without a band are ``ok`` NULL."""
    low = F.create_map(*[F.lit(x) for k, (a, _) in limits.items() for x in (k, float(a))])
    high = F.create_map(*[F.lit(x) for k, (_, b) in limits.items() for x in (k, float(b))])
    return values.select(name, value, F.element_at(low, F.col(name)).alias("low"), F.element_at(high, F.col(name)).alias("high")).withColumn("ok", F.col(value).between(F.col("low"), F.col("high")))


def no_regression(before: DataFrame, after: DataFrame, key: str, count: str, allowance: float = 0.0) -> DataFrame:
    """Counts that may not drop by more than the allowed share; a key gone counts as 0."""
    both = before.select(key, F.col(count).alias("before")).join(after.select(key, F.col(count).alias("after")), key, "full_outer")
    both = both.select(key, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return both.withColumn("ok", F.col("after") >= F.col("before") * (1 - allowance))


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of two tables: how many of each, common, and the share of the smaller."""
    left, right = a.select(key).filter(F.col(key).isNotNull()).distinct(), b.select(key).filter(F.col(key).isNotNull()).distinct()
    marked = left.withColumn("a", F.lit(1)).join(right.withColumn("b", F.lit(1)), key, "full_outer")
    sums = marked.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("in_a"), F.coalesce(F.sum("b"), F.lit(0)).alias("in_b"), F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("common"))
    return sums.withColumn("percent_of_smaller", F.round(100 * F.try_divide(F.col("common"), F.least("in_a", "in_b")), 2))


def contract(df: DataFrame, mapped: list[str], required: list[str]) -> list[str]:
    """Columns a file was promised to have and hasn't: reason to stop before anything is written."""
    return sorted(set(mapped + required) - {c for c, kind in df.dtypes if kind != T.NullType().simpleString()})


def confusion(df: DataFrame, known: str, judged: str) -> DataFrame:
    """How often each known verdict was judged each way."""
    return df.groupBy(known, judged).agg(F.count(F.lit(1)).alias("n"))


class CeilingExceeded(RuntimeError):
    """A rate above what the data may have: stop before anything is written."""


def ceiling(df: DataFrame, broken: Column, most: float, least_rows: int, what: str) -> float:
    """Share of rows for which ``broken`` holds; raises above ``most`` once there are ``least_rows`` of them."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(broken).alias("b")).collect()[0]
    rate = row["b"] / row["n"] if row["n"] else 0.0
    if row["n"] >= least_rows and rate > most:
        raise CeilingExceeded(f"{what}: {rate:.1%} of {row['n']} rows, {most:.1%} allowed")
    return rate
