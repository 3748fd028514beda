"""Duplicate marking: exact key with a survivor, then a lossless similarity join, never overwriting a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.names import array_jaccard, trigrams
from gristmill.session import cut_lineage


def exact_key(df: DataFrame, id_col: str, keys: list[Column], identifier: str, order: list[Column]) -> DataFrame:
    """(id, survivor, members) of rows whose key another row shares.

    The survivor is the first by ``order`` then id; rows with another non-NULL identifier than the survivor's are
    never marked. NULL or empty keys group nothing. One aggregation and one join back; no window.
    """
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    rows = df.select("*", *named)
    on = [f"_k{i}" for i in range(len(keys))]
    for k in on:
        rows = rows.filter(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    first = F.min(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col(id_col).alias("id"), F.col(identifier).alias("identifier")))
    groups = rows.groupBy(*on).agg(first.alias("s"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    joined = rows.join(groups, on).filter(F.col(id_col) != F.col("s.id"))
    same = F.col(identifier).isNull() | F.col(identifier).eqNullSafe(F.col("s.identifier"))
    return joined.filter(same).select(F.col(id_col), F.col("s.id").alias("survivor"), "members")


#: Counts of words or trigrams are kept by a hash of this many values: what orders them by rarity, whatever the data's size.
SLOTS = 1 << 16


def rarest_first(values: DataFrame) -> Callable[[str | Column], Column]:
    """What puts an ARRAY of texts in one order for all rows, the rarest first, by how often they are in ``values`` (one column)."""
    slot = lambda g: F.pmod(F.xxhash64(g), F.lit(SLOTS)).cast("int")
    counted = values.select(slot(F.col(values.columns[0])).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n")).collect()  # SLOTS rows at most
    counts = [0] * SLOTS
    for r in counted:
        counts[r["slot"]] = r["n"]
    table = F.split(F.lit(",".join(map(str, counts))), ",").cast("array<bigint>")  # one constant of the plan

    def ordered(words: str | Column) -> Column:
        ranked = F.transform(words, lambda g: F.struct(F.element_at(table, slot(g) + 1).alias("n"), F.xxhash64(g).alias("h"), g.alias("g")))
        return F.transform(F.array_sort(ranked), lambda x: x["g"])

    return ordered


def similar_pairs(df: DataFrame, id_col: str, text: Column, blocks: list[str], least: float, hot_from: int = 2_000) -> DataFrame:
    """(id_a, id_b, similarity) of rows of one block whose trigram similarity is at least ``least``, id_a < id_b.

    Rows of equal trigrams are copies: the least id stands for them, each copy is linked to it (similarity 1), and only
    these representatives are compared, so n copies give n - 1 links. Prefix filter: with trigrams ordered from the
    rarest on, two sets that similar share one of the first n - ceil(least * n) + 1 of either; ids meet only there,
    where their sizes and the places of the shared trigram still allow it. The sets themselves join the pairs that are
    left. A trigram of more than ``hot_from`` representatives of a block is salted. No pair of different texts is lost.
    Rows without trigrams or with a NULL block match nothing; repeated ids count once.
    """
    rows = df.select(F.col(id_col).alias("id"), *[F.col(b).alias(f"b{k}") for k, b in enumerate(blocks)], F.array_sort(trigrams(text)).alias("grams")).filter(F.size("grams") > 0)
    block = [f"b{k}" for k in range(len(blocks))]
    for b in block:
        rows = rows.filter(F.col(b).isNotNull())
    rows = cut_lineage(rows.withColumn("same", F.xxhash64(*block, "grams")))
    firsts = rows.groupBy("same", *block, "grams").agg(F.min("id").alias("id")).drop("same")
    firsts = cut_lineage(firsts.withColumn("grams", rarest_first(rows.select(F.explode("grams")))("grams")))
    own = firsts.select(F.col("id").alias("id_a"), *block, F.array_sort("grams").alias("grams"))
    copies = rows.join(own.withColumn("same", F.xxhash64(*block, "grams")), ["same", *block, "grams"]).filter("id <> id_a").select("id_a", F.col("id").alias("id_b"), F.lit(1.0).alias("similarity")).distinct()
    length = F.size("grams") - F.ceil(F.size("grams") * F.lit(least)).cast("int") + 1
    keyed = firsts.select("id", *block, F.size("grams").alias("n"), F.posexplode(F.slice("grams", 1, length)).alias("at", "gram"))
    salts = keyed.groupBy(*block, "gram").agg(F.ceil(F.count(F.lit(1)) / hot_from).cast("int").alias("salts")).filter("salts > 1")
    salted = keyed.join(salts, [*block, "gram"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    a = salted.select(F.col("id").alias("id_a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), *block, "gram", F.pmod(F.xxhash64("id"), "salts").cast("int").alias("salt"))
    b = salted.select(F.col("id").alias("id_b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), *block, "gram", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    enough = F.ceil((F.col("n_a") + F.col("n_b")) * F.lit(least / (1 + least)) - 1e-9)
    reachable = (F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= enough) & (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * least)
    met = a.join(b, [*block, "gram", "salt"]).filter((F.col("id_a") < F.col("id_b")) & reachable).select("id_a", "id_b").distinct()
    sets = firsts.select("id", "grams")
    both = met.join(sets.toDF("id_a", "grams_a"), "id_a").join(sets.toDF("id_b", "grams_b"), "id_b")
    scored = both.withColumn("similarity", array_jaccard(F.col("grams_a"), F.col("grams_b"))).filter(F.col("similarity") >= least)
    return scored.select("id_a", "id_b", "similarity").unionByName(copies)


def mark(df: DataFrame, id_col: str, passes: list[DataFrame]) -> DataFrame:
    """``df`` with ``duplicate_of`` and ``pass``: each pass (id, survivor) only marks rows that no earlier one marked.

    A survivor that is itself marked is no target, so there are no chains, and no row points to itself.
    """
    marked = df.select(id_col).limit(0).withColumn("duplicate_of", F.col(id_col)).withColumn("pass", F.lit(0))
    for number, found in enumerate(passes, 1):
        fresh = found.select(F.col(found.columns[0]).alias(id_col), F.col("survivor").alias("duplicate_of")).filter(F.col(id_col) != F.col("duplicate_of"))
        fresh = fresh.groupBy(id_col).agg(F.min("duplicate_of").alias("duplicate_of")).join(marked.select(id_col), id_col, "left_anti")
        targets = marked.select(F.col(id_col).alias("duplicate_of")).unionByName(fresh.select(F.col(id_col).alias("duplicate_of")))
        fresh = fresh.join(targets, "duplicate_of", "left_anti")
        marked = marked.unionByName(fresh.withColumn("pass", F.lit(number)).select(id_col, "duplicate_of", "pass"))
    return df.join(marked, id_col, "left")
