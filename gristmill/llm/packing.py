"""Filling containers of fixed capacity: minimum bin slack over windows of items.

An item longer than the capacity is cut: each full cut is a container of its own, the rest is an item like any other.
Items are dealt into windows by a hash, and each window is packed by itself: the longest item left opens a container,
and a subset-sum dynamic programme over bit sets finds which of the remaining lengths come closest to the space left;
its layers are walked backwards to get how many items of each length to take. What a window can't fill to
``fill`` is packed once more with the leftovers of its neighbours.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import cut_lineage

RESULT = "container_set string, capacity int, container_id string, doc_id bigint, part int, tokens int, used int, slack int"


def fullest(lengths: dict[int, int], space: int) -> list[int]:
    """Lengths, with repeats, whose sum is the greatest not above ``space``; at a tie the longest lengths.

    ``lengths`` gives how many items there are of each length. Counts are split into powers of two, so a layer of the
    programme is one shift of a bit set of ``space`` + 1 bits.
    """
    mask, layers, reach = (1 << (space + 1)) - 1, [], 1
    for length in sorted((n for n in lengths if 0 < n <= space)):
        left, size = min(lengths[length], space // length), 1
        while left > 0:
            take = min(size, left)
            layers.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            size *= 2
        if reach == mask:  # every sum can be reached already
            break
    total, chosen = reach.bit_length() - 1, []
    for length, take, before in reversed(layers):
        if not total:
            break
        if total >= length * take and (before >> (total - length * take)) & 1:
            chosen += [length] * take
            total -= length * take
    return chosen


def pack(items: list[tuple[int, object]], capacity: int) -> list[list[tuple[int, object]]]:
    """Containers of (length, item) by minimum bin slack, each seeded with the longest item left."""
    by_length: dict[int, list] = defaultdict(list)
    for length, item in sorted(items, key=lambda x: (x[0], str(x[1])), reverse=True):
        by_length[length].append(item)
    counts = {n: len(v) for n, v in by_length.items() if n}
    containers = []
    while counts:
        seed = max(counts)
        chosen = [seed]
        counts[seed] -= 1
        if not counts[seed]:
            del counts[seed]
        for length in fullest(counts, capacity - seed):
            chosen.append(length)
            counts[length] -= 1
            if not counts[length]:
                del counts[length]
        containers.append([(n, by_length[n].pop()) for n in chosen])
    empty = [(0, item) for item in by_length.get(0, [])]
    if empty:
        containers = containers or [[]]
        containers[0] = containers[0] + empty
    return containers


def pack_documents(sizes: DataFrame, sets: DataFrame, window: int = 2048, merge: int = 64, fill: float = 0.98) -> DataFrame:
    """Every document in containers of every capacity, with the container's used and unused space.

    ``sizes`` is (id, tokens), ``sets`` (container_set, capacity_tokens), a few rows. Sets with a NULL or
    non-positive capacity are left out. An empty document goes into a container of its window and takes no space;
    repeated ids are items of their own; no documents give no containers. Only a document longer than the capacity is
    cut (part 0, 1, ...). A window holds about ``window`` items whatever the data's size, so no task grows.
    """
    sizes = cut_lineage(sizes.select("id", "tokens"))  # encoded once, used by every set and both rounds
    documents = sizes.count()
    windows = max(1, documents // window)
    sets = sets.filter("capacity_tokens > 0").select("container_set", F.col("capacity_tokens").cast("int").alias("capacity")).distinct()
    choices = [(r["container_set"], r["capacity"]) for r in sets.collect()]  # a few rows by definition
    if not choices:
        return sizes.sparkSession.createDataFrame([], RESULT)
    items = sizes.withColumn("s", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(c).alias("c")) for n, c in choices]))).select("id", "tokens", F.col("s.n").alias("container_set"), F.col("s.c").alias("capacity"))
    full = F.floor(F.col("tokens") / F.col("capacity")).cast("int")
    rest = (F.col("tokens") - full * F.col("capacity")).cast("int")
    cuts = items.filter(F.col("tokens") >= F.col("capacity")).select("container_set", "capacity", "id", F.explode(F.sequence(F.lit(0), full - 1)).alias("part"))
    whole = cuts.select(
        "container_set", "capacity", F.concat_ws("-", F.lit("w"), F.col("id"), F.col("part")).alias("container_id"), F.col("id").alias("doc_id"), "part",
        F.col("capacity").alias("tokens"), F.col("capacity").alias("used"), F.lit(0).alias("slack"),
    )
    loose = items.filter((rest > 0) | (F.col("tokens") == 0)).select(
        "container_set", "capacity", "id", full.alias("part"), rest.alias("tokens"),
        F.pmod(F.xxhash64("id"), F.lit(windows)).alias("window"),
    )

    def packer(prefix: str):
        def one(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            name, capacity, number = key
            rows = []
            packed = pack(list(zip(group["tokens"].tolist(), zip(group["id"].tolist(), group["part"].tolist()))), int(capacity))
            for k, container in enumerate(packed):
                used = sum(n for n, _ in container)
                rows += [(name, capacity, f"{prefix}-{number}-{k}", doc, part, n, used, capacity - used) for n, (doc, part) in container]
            return pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

        return one

    first = cut_lineage(loose.groupBy("container_set", "capacity", "window").applyInPandas(packer("a"), RESULT))
    poor = F.col("used") < F.col("capacity") * fill
    again = first.filter(poor).select("container_set", "capacity", F.col("doc_id").alias("id"), "part", "tokens",
                                      F.floor(F.split("container_id", "-")[1].cast("bigint") / merge).alias("window"))
    second = again.groupBy("container_set", "capacity", "window").applyInPandas(packer("b"), RESULT)
    return whole.unionByName(first.filter(~poor)).unionByName(second)


def container_report(packed: DataFrame) -> DataFrame:
    """Containers of each set with their used and unused space."""
    each = packed.groupBy("container_set", "capacity", "container_id").agg(F.first("used").alias("used"), F.count(F.lit(1)).alias("items"))
    return each.groupBy("container_set", "capacity").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("items").alias("items"), F.sum("used").alias("used"),
        F.sum(F.col("capacity") - F.col("used")).alias("slack"),
        F.round(F.sum("used") / F.sum("capacity"), 6).alias("fill"),
    )
