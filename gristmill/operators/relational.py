"""Best child, first per group, collapses, top-k, disjunctive joins: without windows over hot groups where possible."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nulls_last(c: Column) -> Column:
    """Ascending key with NULL behind everything."""
    return F.struct(c.isNull().alias("n"), c.alias("v"))


def descending(c: Column) -> Column:
    """Ascending key of a number or time from the greatest down, NULL behind everything."""
    return F.struct(c.isNull().alias("n"), (-c).alias("v"))


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group by ``order`` (ascending keys), equal keys settled by the row itself.

    A map-side minimum of (order, row): a group that holds a third of all rows is reduced where it lies, never
    sorted or collected. NULL is a key like any other.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(order)], F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    best = df.groupBy(*keys).agg(F.min(row)["row"].alias("row"))
    return best.select(*keys, *[F.col("row")[c].alias(c) for c in rest])


def best_child(parents: DataFrame, children: DataFrame, key: str, keep: Column, order: list[Column]) -> DataFrame:
    """Each parent with its first admissible child; parents without one keep NULL."""
    return parents.join(first_per_group(children.filter(keep), [key], order), key, "left")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; Spark prunes each partition to ``k`` rows a group before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= k)


def missing_from(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other side hasn't; NULL keys are kept, as nothing matches them."""
    return df.join(other.select(key).distinct(), key, "left_anti")


def either_join(left: DataFrame, right: DataFrame, conditions: list[Column], ids: list[str]) -> DataFrame:
    """Join on any of several equi-conditions: one hash join each, then distinct pairs. No nested loop."""
    parts = [left.join(right, c).select(*ids) for c in conditions]
    return reduce(DataFrame.unionByName, parts).dropDuplicates(ids)


def union_to(schema: list[str], frames: dict[str, DataFrame]) -> DataFrame:
    """Union of differing sources to one schema with the source's name; what a source lacks is NULL."""
    parts = [df.select(*[(F.col(f"`{c}`").cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in schema], F.lit(name).alias("source")) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def sample_by_hash(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows chosen by a hash of their key: the same ones for any partitioning and any run."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


def most_frequent(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent non-NULL value of each group, the least of several; two map-side aggregations."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("k"), F.col(value).alias("v"))).alias("x")).select(*keys, F.col("x.v").alias(value), (-F.col("x.k")).alias("n"))


def first_tag(tags: Column, *names: str) -> Column:
    """First of several spellings of a tag that a MAP has."""
    return F.coalesce(*[F.nullif(F.trim(F.element_at(tags, n)), F.lit("")) for n in names])
