"""Mixing sources to target weights: balanced sampling by the cube method.

The size of the mixture is the largest at which every source can give its share within its repeats. A document of a
source that must give r times its tokens is used floor(r) times, and once more with probability r - floor(r). Those
fractions are drawn together by the cube method: a block of documents moves along a null-space direction of its
constraints (tokens and documents) until all but a few fractions are 0 or 1; the few left of every block flow on to the
next level, and at the end a landing decides the last two or three of a source.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.session import cut_lineage

EPS = 1e-9


def _move(x: np.ndarray, u: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One step along ``u``, either way, as far as the first fraction that becomes 0 or 1; expectations are kept."""
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.min(np.where(u > 0, (1 - x) / u, np.where(u < 0, -x / u, np.inf)))
        down = np.min(np.where(u > 0, x / u, np.where(u < 0, (x - 1) / u, np.inf)))
    x = np.clip(x + (up if rng.random() * (up + down) < down else -down) * u, 0, 1)
    x[x < EPS], x[x > 1 - EPS] = 0, 1
    return x


def flight(fractions: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Fractions after the flight: all but at most two are 0 or 1, and sum(fraction * size) is what it was.

    Documents above the median size move in pairs of neighbouring sizes along the null space of the token constraint,
    longest first, so that no long one is left for the landing; the rest move three at a time along the null space of
    both constraints, tokens and documents. Which way a step goes is drawn so that each fraction keeps its expectation.
    """
    rng = np.random.default_rng(seed)
    p = fractions.astype(float).copy()
    order = np.lexsort((rng.random(len(p)), -size))
    todo = [int(k) for k in order if EPS < p[k] < 1 - EPS]
    middle = size[todo[len(todo) // 2]] if todo else 0
    together: list[int] = []
    for k in todo:
        together.append(k)
        if size[k] > middle and len(together) == 2:
            u = np.array([size[together[1]], -size[together[0]]], dtype=float)
        elif len(together) == 3:
            a, b, c = size[together]
            u = np.array([b - c, c - a, a - b], dtype=float)
            u = u if u.any() else np.array([1.0, -1.0, 0.0])
        else:
            continue
        p[together] = _move(p[together], u / np.abs(u).max(), rng)
        together = [j for j in together if 0 < p[j] < 1]
    return p


def landing(fractions: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Decide the last fractions: of all 0/1 choices, the one whose tokens come closest to what was expected."""
    p = fractions.copy()
    left = np.nonzero((p > EPS) & (p < 1 - EPS))[0]
    if len(left):
        target = float((p[left] * size[left]).sum())
        choices = np.array(np.meshgrid(*[[0, 1]] * len(left))).T.reshape(-1, len(left))
        p[left] = choices[np.argmin(np.abs(choices @ size[left] - target))]
    return np.round(p)


def plan(totals: pd.DataFrame, targets: pd.DataFrame) -> pd.DataFrame:
    """(source, repeats): tokens wanted over tokens there are, for the largest mixture within every source's repeats.

    Sources without tokens, or with a share of 0 or NULL, give nothing and don't bound the rest.
    """
    t = targets.merge(totals, on="source", how="inner")
    t = t[(t["tokens"] > 0) & (t["target_share"] > 0) & (t["max_repeats"] > 0)]
    if not len(t):
        return pd.DataFrame({"source": pd.Series(dtype=str), "repeats": pd.Series(dtype=float)})
    whole = float((t["tokens"] * t["max_repeats"] / t["target_share"]).min())
    return pd.DataFrame({"source": t["source"], "repeats": np.minimum(whole * t["target_share"] / t["tokens"], t["max_repeats"])})


def mix(sizes: DataFrame, targets: DataFrame, block: int = 4096, seed: int = 7) -> DataFrame:
    """(doc_id, source, tokens, repeats) of the chosen documents, ``repeats`` at least 1.

    ``sizes`` is (id, source, tokens), ``targets`` (source, target_share, max_repeats), a few rows. Documents of other
    or NULL sources, and empty ones, are never chosen. The draw depends on ids and ``seed`` alone, so any partitioning
    gives the same mixture. Every level holds blocks of at most about ``block`` documents, whichever source they are of.
    """
    spark = sizes.sparkSession
    targets = targets.filter("source IS NOT NULL").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    sizes = cut_lineage(sizes.filter("tokens > 0 AND source IS NOT NULL").join(F.broadcast(targets.select("source")), "source", "left_semi"))
    totals = sizes.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents")).toPandas()  # a row a source
    repeats = plan(totals, targets.toPandas())
    wanted = spark.createDataFrame(repeats.merge(totals[["source", "documents"]], on="source"), "source string, repeats double, documents bigint")
    rows = sizes.join(F.broadcast(wanted), "source")
    rows = rows.withColumn("base", F.floor("repeats").cast("int")).withColumn("p", F.col("repeats") - F.col("base"))
    rows = rows.withColumn("blocks", F.ceil(F.col("documents") / block)).withColumn("b", F.pmod(F.xxhash64(F.lit(seed), "id"), F.col("blocks")))
    shape = "id bigint, source string, tokens bigint, base int, p double, b bigint"

    def step(final: bool, level: int):
        def one(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("id", kind="stable")
            start = zlib.crc32(f"{seed}/{level}/{key[0]}/{key[1]}".encode())
            size = group["tokens"].to_numpy(dtype=float)
            p = flight(group["p"].to_numpy(), size, start)
            return group.assign(p=landing(p, size, start) if final else p)[["id", "source", "tokens", "base", "p", "b"]]

        return one

    open_ = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    most, level, done = int(-(-max(totals["documents"], default=1) // block)), 0, None
    current = rows.select("id", "source", "tokens", "base", "p", "b")
    while True:
        final = most <= 1
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        moved = cut_lineage(current.repartition(tasks, "source", "b").groupBy("source", "b").applyInPandas(step(final, level), shape))  # few bytes and much work: not to be merged into one task
        settled = moved if final else moved.filter(~open_)
        done = settled if done is None else done.unionByName(settled)
        if final:
            break
        # at most two of a block are still open: a level has block / 2 times fewer blocks than the one before
        current = moved.filter(open_).withColumn("b", F.floor(F.col("b") / (block // 2)))
        most, level = -(-most // (block // 2)), level + 1
    chosen = done.withColumn("repeats", (F.col("base") + F.round("p")).cast("int"))
    return chosen.filter("repeats > 0").select(F.col("id").alias("doc_id"), "source", "tokens", "repeats")


def shares(chosen: DataFrame, targets: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Actual share of each source beside its target.

    With ``sizes`` also the documents, repeats counted, that the plan asks for, and those chosen: the second constraint,
    which the longer half of the documents only nearly keeps.
    """
    got = chosen.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.sum("repeats").alias("uses"), F.max("repeats").alias("most_repeats"))
    joined = targets.join(got, "source", "left").withColumn("all_tokens", F.sum("tokens").over(Window.partitionBy()))  # a row a source
    columns = ["source", "target_share", "max_repeats", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("documents", "tokens", "most_repeats")], F.round(F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)), 6).alias("actual_share")]
    if sizes is None:
        return joined.select(*columns)
    wanted = targets.filter("source IS NOT NULL").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).toPandas()
    totals = sizes.filter("tokens > 0 AND source IS NOT NULL").groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")).toPandas()
    planned = plan(totals, wanted).merge(totals[["source", "n"]], on="source")
    asked = chosen.sparkSession.createDataFrame(planned.assign(expected_uses=planned["repeats"] * planned["n"])[["source", "expected_uses"]], "source string, expected_uses double")
    return joined.join(F.broadcast(asked), "source", "left").select(*columns, F.coalesce("uses", F.lit(0)).alias("uses"), F.round(F.coalesce("expected_uses", F.lit(0.0)), 2).alias("expected_uses"))
