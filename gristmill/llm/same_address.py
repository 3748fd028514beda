"""Same postal address written differently: probabilistic linkage of address records.

Addresses are taken apart, distinct ones kept once. Candidates share a postcode or a commune, the number, and how the
start or the end of the way's name sounds. Each pair gets an agreement level for postcode, commune, kind of way,
suffix and name, a missing value being a level of its own; a name a letter away has two levels, by how rare the rarer
spelling is. The counts of level patterns (a few hundred, whatever the data's size) go to the driver, where
expectation-maximization estimates how likely each level is among pairs of one place and of two, and a pair is linked
where these weights say so. Parts that contradict each other (another kind of way, another postcode) settle a pair as
two places before, and teach the estimate what such pairs look like. Linked addresses are closed into sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.address_parts import parse, sounds
from gristmill.llm.graph import components
from gristmill.session import cut_lineage

PARTS = ["number", "suffix", "kind", "name", "postcode", "commune"]
LEVELS = ["postcode_level", "commune_level", "kind_level", "suffix_level", "name_level"]
#: Highest level of each, and which of them are contradictions where they are 0.
TOP = [3, 3, 3, 1, 5]
CONTRADICTING = [0, 1, 2, 3, 4]
#: A spelling is rare where it is written at most this often for each time the other is, or for each time a usual name is
#: (once in any case).
RARE, RARE_ALONE = 0.35, 0.1
#: What is believed before any pair is seen counts as so many pairs: a share of one place, and more agreement there.
PRIOR, PRIOR_SHARE = 1.0, 0.3


def parsed(df: DataFrame, key: str, address: str, postcode: str, commune: str) -> DataFrame:
    """(key, parts, sound keys of the name). Over Arrow batches, no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            rows = [parse(a, p, c) for a, p, c in zip(b["a"], b["p"], b["c"])]
            out = pd.DataFrame(rows, columns=PARTS)
            yield out.assign(key=b["key"].to_numpy(), sounds=[sounds(n) for n in out["name"]])[["key", *PARTS, "sounds"]]

    lean = df.select(F.col(key).alias("key"), F.col(address).alias("a"), F.col(postcode).alias("p"), F.col(commune).alias("c"))
    return lean.mapInPandas(run, "key string, " + ", ".join(f"{p} string" for p in PARTS) + ", sounds array<string>")


def near_text(a: Column, b: Column, least: int = 5) -> Column:
    """Whether two texts are one letter changed, added, left out or swapped apart; short ones must be equal."""
    distance = F.levenshtein(a, b, 2)
    swapped = (distance == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return (a == b) | ((F.least(F.length(a), F.length(b)) >= least) & ((distance.between(0, 1)) | swapped))


def small_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", most: int = 200_000) -> DataFrame:
    """Join with a dictionary whose rows are counted first: broadcast up to ``most`` rows, shuffled beyond."""
    return left.join(F.broadcast(right) if right.limit(most + 1).count() <= most else right, on, how)


def resolve_communes(rows: DataFrame) -> DataFrame:
    """``rows`` with misspelt communes set right and missing ones filled where only one is possible.

    A commune that is a letter away from a more frequent one of its postcode is that one. A missing commune (or
    postcode) is filled where the postcode (the commune) has only one, or where only one has a way of that name.
    """
    counted = rows.filter("postcode <> '' AND commune <> ''").groupBy("postcode", "commune").agg(F.count(F.lit(1)).alias("n"))
    counted = cut_lineage(counted.withColumn("bone", F.regexp_replace("commune", "[AEIOUHWY ]", "")))
    keyed = counted.select("*", F.explode(F.array_distinct(F.array(F.concat(F.lit("<"), F.substring("bone", 1, 4)), F.concat(F.lit(">"), F.expr("right(bone, 4)"))))).alias("bones"))
    other = keyed.select("postcode", "bones", F.col("commune").alias("better"), F.col("n").alias("m"))
    fixes = keyed.join(other, ["postcode", "bones"]).filter((F.col("m") > F.col("n")) & near_text(F.col("commune"), F.col("better")) & (F.col("commune") != F.col("better")))
    fixes = cut_lineage(fixes.groupBy("postcode", "commune").agg(F.max(F.struct("m", "better"))["better"].alias("better")))
    rows = small_join(rows, fixes, ["postcode", "commune"]).withColumn("commune", F.coalesce("better", "commune")).drop("better")
    known = small_join(counted, fixes, ["postcode", "commune"]).select("postcode", F.coalesce("better", "commune").alias("commune")).distinct()
    known = cut_lineage(known)
    one_commune = known.groupBy("postcode").agg(F.count(F.lit(1)).alias("k"), F.first("commune").alias("only_commune")).filter("k = 1").drop("k")
    one_postcode = known.groupBy("commune").agg(F.count(F.lit(1)).alias("k"), F.first("postcode").alias("only_postcode")).filter("k = 1").drop("k")
    rows = small_join(small_join(rows, one_commune, ["postcode"]), one_postcode, ["commune"])
    rows = rows.withColumn("commune", F.when(F.col("commune") == "", F.coalesce("only_commune", F.lit(""))).otherwise(F.col("commune")))
    rows = rows.withColumn("postcode", F.when(F.col("postcode") == "", F.coalesce("only_postcode", F.lit(""))).otherwise(F.col("postcode"))).drop("only_commune", "only_postcode")
    rows = cut_lineage(rows)
    whole, part = rows.filter("postcode <> '' AND commune <> ''"), rows.filter("postcode = '' OR commune = ''")
    ways = whole.filter("name <> ''").groupBy("postcode", "commune", "kind", "name").agg(F.count(F.lit(1)).alias("n"))
    by_postcode = ways.groupBy("postcode", "kind", "name").agg(F.count(F.lit(1)).alias("k"), F.first("commune").alias("way_commune")).filter("k = 1").drop("k")
    by_commune = ways.groupBy("commune", "kind", "name").agg(F.count(F.lit(1)).alias("k"), F.first("postcode").alias("way_postcode")).filter("k = 1").drop("k")
    part = part.join(by_postcode, ["postcode", "kind", "name"], "left").join(by_commune, ["commune", "kind", "name"], "left")
    part = part.withColumn("commune", F.when((F.col("commune") == "") & (F.col("postcode") != ""), F.coalesce("way_commune", F.lit(""))).otherwise(F.col("commune")))
    part = part.withColumn("postcode", F.when((F.col("postcode") == "") & (F.col("commune") != ""), F.coalesce("way_postcode", F.lit(""))).otherwise(F.col("postcode")))
    return whole.unionByName(part.drop("way_commune", "way_postcode"))


def level(a: str, b: str, near: Column | None = None) -> Column:
    """3 same, 2 near, 1 one missing, 0 different, of two columns where '' is missing."""
    x, y = F.col(a), F.col(b)
    out = F.when((x == "") | (y == ""), 1).when(x == y, 3)
    return (out.when(near, 2) if near is not None else out).otherwise(0)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Probability that a pair of each pattern is one place: two latent classes, levels independent within each.

    Patterns with a contradiction are of the second class from the start and stay there: from them is known how often
    two places agree in their other parts.
    """
    if not len(counts):
        return np.zeros(0)
    sizes = [max(int(patterns[:, k].max()), TOP[k] if k < len(TOP) else 0) + 1 for k in range(patterns.shape[1])]
    against = (patterns[:, [k for k in CONTRADICTING if k < len(sizes)]] == 0).any(axis=1) if patterns.shape[1] == len(LEVELS) else np.zeros(len(counts), dtype=bool)
    rising = [np.arange(1, s + 1, dtype=float) ** 3 for s in sizes]
    m0, u0 = [r / r.sum() for r in rising], [r[::-1] / r.sum() for r in rising]
    share, m, u = PRIOR_SHARE, list(m0), list(u0)
    for _ in range(rounds):
        a = np.log(share) + sum(np.log(m[k][patterns[:, k]]) for k in range(len(sizes)))
        b = np.log(1 - share) + sum(np.log(u[k][patterns[:, k]]) for k in range(len(sizes)))
        p = np.where(against, 0.0, 1 / (1 + np.exp(np.clip(b - a, -500, 500))))
        share = float(((p * counts).sum() + PRIOR * PRIOR_SHARE) / (counts.sum() + PRIOR))
        for k, s in enumerate(sizes):
            hit = np.bincount(patterns[:, k], weights=p * counts, minlength=s) + PRIOR * m0[k]
            miss = np.bincount(patterns[:, k], weights=(1 - p) * counts, minlength=s) + PRIOR * u0[k]
            m[k], u[k] = hit / hit.sum(), miss / miss.sum()
    return p


def locations(df: DataFrame, key: str, address: str, postcode: str, commune: str) -> DataFrame:
    """(key, location): rows with equal ``location`` stand at one place.

    Rows without a name of a way or place, ways without a number, and rows with neither postcode nor commune are
    located nowhere and left out. Repeated keys may appear once for each place they give.
    """
    rows = resolve_communes(parsed(df, key, address, postcode, commune))
    rows = rows.filter("name <> '' AND (kind = 'PLACE_NAME' OR number <> '') AND (postcode <> '' OR commune <> '')")
    rows = cut_lineage(rows.withColumn("rep", F.xxhash64(*PARTS)))
    distinct = rows.groupBy("rep").agg(*[F.first(c).alias(c) for c in [*PARTS, "sounds"]], (F.min("key") < F.max("key")).alias("repeated"))
    written = distinct.groupBy("name").agg(F.count(F.lit(1)).alias("written"))  # a slip is rare beside the name it is of; by addresses, so rows held several times change nothing
    reps = cut_lineage(distinct.join(written, "name"))
    usual = reps.agg(F.percentile_approx("written", F.lit(0.5)).alias("usual"), F.count_if("repeated").alias("repeated")).collect()[0]
    place_key = lambda place, tag: F.when(F.col(place) != "", F.transform("sounds", lambda s: F.xxhash64(F.lit(tag), F.col(place), F.col("number"), s))).otherwise(F.array().cast("array<bigint>"))
    keyed = reps.withColumn("block", F.explode(F.array_distinct(F.concat(place_key("postcode", "p"), place_key("commune", "c")))))
    left = keyed.select("block", *[F.col(c).alias(f"a_{c}") for c in ["rep", "written", *PARTS]])
    right = keyed.select("block", *[F.col(c).alias(f"b_{c}") for c in ["rep", "written", *PARTS]])
    pairs = left.join(right, "block").filter("a_rep < b_rep").drop("block").dropDuplicates(["a_rep", "b_rep"])
    a, b = F.split("a_name", " "), F.split("b_name", " ")
    first = lambda x: F.element_at(x, 1)
    last = lambda x: F.element_at(x, -1)
    initial = (F.size(a) > 1) & (F.size(b) > 1) & near_text(last(a), last(b)) & (F.least(F.length(first(a)), F.length(first(b))) == 1) & (F.substring(first(a), 1, 1) == F.substring(first(b), 1, 1))
    some, slip = F.arrays_overlap(a, b), near_text(F.col("a_name"), F.col("b_name"))
    least, most = F.least("a_written", "b_written"), F.greatest("a_written", "b_written")
    rare = (least <= RARE * most) | (least <= max(1.0, RARE_ALONE * (usual["usual"] or 1)))
    name_level = F.when(F.col("a_name") == F.col("b_name"), 5).when(initial, 4).when(slip & rare, 3).when(slip, 2).when(some, 1).otherwise(0)
    pairs = cut_lineage(pairs.select(
        "a_rep", "b_rep", "a_commune", "b_commune", "a_kind", "b_kind",
        level("a_postcode", "b_postcode").alias("postcode_level"),
        level("a_commune", "b_commune", near_text(F.col("a_commune"), F.col("b_commune"))).alias("commune_level"),
        level("a_kind", "b_kind").alias("kind_level"),
        F.when(F.col("a_suffix") == F.col("b_suffix"), 1).otherwise(0).alias("suffix_level"),
        name_level.alias("name_level"),
    ))
    seen = pairs.groupBy(*LEVELS).count().toPandas()  # at most 4 * 4 * 4 * 2 * 6 rows
    patterns, counts = seen[LEVELS].to_numpy(dtype=int).reshape(-1, len(LEVELS)), seen["count"].to_numpy(dtype=float)
    # addresses written alike by several are pairs of one place too, and never met above
    chance = estimate(np.concatenate([patterns, [TOP]]), np.append(counts, float(usual["repeated"])))[: len(patterns)]
    good = [tuple(map(int, row)) for row, p in zip(patterns, chance) if p >= 0.5]
    agree = F.lit(False)
    for pattern in good:
        agree = agree | F.struct(*LEVELS).eqNullSafe(F.struct(*[F.lit(x).alias(c) for x, c in zip(pattern, LEVELS)]))
    links = cut_lineage(pairs.filter(agree))
    # an address with a part missing must not tie two places together: it may only join neighbours that agree
    both = links.select("a_rep", "a_commune", "a_kind", "b_commune", "b_kind").union(links.select("b_rep", "b_commune", "b_kind", "a_commune", "a_kind"))
    torn = both.toDF("rep", "c", "k", "oc", "ok").groupBy("rep").agg(
        F.max(F.when((F.col("c") == "") & (F.col("oc") != ""), F.col("oc"))).alias("c1"), F.min(F.when((F.col("c") == "") & (F.col("oc") != ""), F.col("oc"))).alias("c2"),
        F.max(F.when((F.col("k") == "") & (F.col("ok") != ""), F.col("ok"))).alias("k1"), F.min(F.when((F.col("k") == "") & (F.col("ok") != ""), F.col("ok"))).alias("k2"),
    ).filter(((F.col("c1") != F.col("c2")) & ~near_text(F.col("c1"), F.col("c2"))) | (F.col("k1") != F.col("k2"))).select("rep")
    links = links.join(torn.withColumnRenamed("rep", "a_rep"), "a_rep", "left_anti").join(torn.withColumnRenamed("rep", "b_rep"), "b_rep", "left_anti")
    sets = components(links, "a_rep", "b_rep").select(F.col("node").alias("rep"), "component")
    return rows.join(sets, "rep", "left").select("key", F.coalesce("component", "rep").alias("location")).distinct()


def pairs_at_one_place(located: DataFrame) -> DataFrame:
    """Each pair of different keys of one location, least first.

    The output itself is quadratic in a location's keys; a key is joined to those behind it, never collected.
    """
    other = located.withColumnRenamed("key", "other")
    return located.join(other, "location").filter("key < other").select("key", "other").distinct()
