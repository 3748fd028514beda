"""Competing claims: corroboration, guards on shared values, agreement of sources, ranked picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def corroborated(claims: DataFrame, entity: str, value: str, source: str, least: int = 2) -> DataFrame:
    """Values that at least so many distinct sources claim for an entity, with the label ``corrobore(a+b)``.

    Claims without a value or source don't count.
    """
    seen = claims.filter(F.col(value).isNotNull() & F.col(source).isNotNull()).groupBy(entity, value).agg(F.array_sort(F.collect_set(source)).alias("sources"))
    label = F.concat(F.lit("corrobore("), F.array_join("sources", "+"), F.lit(")"))
    return seen.filter(F.size("sources") >= least).select(entity, value, F.size("sources").alias("n_sources"), label.alias("label"))


def shared_values(claims: DataFrame, entity: str, value: str, most: int) -> DataFrame:
    """Values claimed for more than ``most`` distinct entities: switchboards, shared mailboxes, networks."""
    pairs = claims.filter(F.col(value).isNotNull()).select(entity, value).distinct()  # partial on the map side, then one row a pair
    return pairs.groupBy(value).agg(F.count(F.lit(1)).alias("entities")).filter(F.col("entities") > most)


def guarded(claims: DataFrame, entity: str, value: str, most: int) -> DataFrame:
    """Claims without those of shared values."""
    return claims.join(shared_values(claims, entity, value, most).select(value), value, "left_anti")


def agreement(claims: DataFrame, entity: str, value: str, source: str) -> DataFrame:
    """How often each source has a value in common with another source of the same entity, and how often none."""
    own = claims.filter(F.col(value).isNotNull() & F.col(source).isNotNull()).groupBy(entity, source).agg(F.collect_set(value).alias("values"))
    other = own.select(entity, F.col(source).alias("other"), F.col("values").alias("other_values"))
    pairs = own.join(other, entity).filter(F.col(source) != F.col("other"))
    agree = F.arrays_overlap("values", "other_values")
    return pairs.groupBy(source).agg(F.count_if(agree).alias("agree"), F.count_if(~agree).alias("disagree"))


def ranked_pick(claims: DataFrame, entity: str, value: str, source: str, rank: Column) -> DataFrame:
    """The claim of least rank of each entity, then the least value: a map-side minimum."""
    best = F.min(F.when(F.col(value).isNotNull(), F.struct(F.coalesce(rank, F.lit(1 << 30)).alias("rank"), F.col(value).alias("value"), F.col(source).alias("source"))))
    return claims.groupBy(entity).agg(best.alias("b")).filter("b IS NOT NULL").select(entity, F.col("b.value").alias(value), F.col("b.source").alias(source))


def ranked_list(claims: DataFrame, entity: str, value: str, rank: Column, alternates: int = 3) -> DataFrame:
    """First value by rank and up to ``alternates`` others, each value once at its best rank."""
    each = claims.filter(F.col(value).isNotNull()).groupBy(entity, value).agg(F.min(F.coalesce(rank, F.lit(1 << 30))).alias("rank"))
    place = F.row_number().over(Window.partitionBy(entity).orderBy("rank", value))
    kept = each.withColumn("place", place).filter(F.col("place") <= alternates + 1)  # pruned to so many rows before the shuffle
    return kept.groupBy(entity).agg(
        F.max(F.when(F.col("place") == 1, F.col(value))).alias("first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("place") > 1, F.struct("place", value)))), lambda x: x[value]), " | ").alias("others"),
    )


def crowded(df: DataFrame, group: str, value: str, most: int) -> DataFrame:
    """Rows without the groups that hold more than ``most`` distinct values (a store list on one domain)."""
    return df.join(shared_values(df, value, group, most).select(group), group, "left_anti")


def context(claims: DataFrame, entity: str, rank: Column, first_of: list[str], union_of: list[str]) -> DataFrame:
    """Each of ``first_of`` from the best ranked row that has it; each ``|``-list of ``union_of`` merged without repeats."""
    best = [F.min(F.when(F.trim(c) != "", F.struct(F.coalesce(rank, F.lit(1 << 30)).alias("k"), F.col(c).alias("v"))))["v"].alias(c) for c in first_of]
    tags = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda t: F.trim(t)), lambda t: t != "")
    lists = [F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(tags(c))))), "|").alias(c) for c in union_of]
    return claims.groupBy(entity).agg(*best, *lists)


def admissible(claims: DataFrame, rules: list[tuple[Column, Column | None]], source: str) -> DataFrame:
    """Claims whose source the first rule that applies keeps or renames; a rule with no name drops the claim."""
    named: Column | None = None
    for condition, name in rules:
        value = F.lit(None).cast("string") if name is None else name
        named = F.when(condition, value) if named is None else named.when(condition, value)
    kept = F.col(source) if named is None else named.otherwise(F.col(source))
    return claims.withColumn(source, kept).filter(F.col(source).isNotNull())


def first_site(results: DataFrame, entity: str, position: str, host: str, aside: list[str]) -> DataFrame:
    """The first result of each entity whose host is no aggregator, with its position."""
    own = F.col(host).isNotNull() & ~F.col(host).rlike("(" + "|".join(a.replace(".", r"\.") for a in aside) + ")")
    return results.filter(own).groupBy(entity).agg(F.min(F.struct(F.col(position).alias("position"), F.col(host).alias("host"))).alias("x")).select(entity, "x.host", "x.position")
