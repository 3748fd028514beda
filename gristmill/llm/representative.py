"""Best representative of each duplicate group, chosen field by field.

Currency reasoning settles which row is the latest. From the rows that carry a time, transitions between the values
of a few attributes with a small range (version, status) are counted; a value that clearly precedes another gives an
edge of a precedence graph, and the graph's topological levels order the values. A row without a time is placed in its
group's partial order: after all timed rows of lower or equal level, and later than them where its own level is
higher. Survivors are the least (rank, latest, id) per group and field, a map-side minimum: no group is collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most pairs of values that may precede each other in one attribute; one with more has no small range, and is refused.
MOST_EDGES = 10_000


def transitions(rows: DataFrame, group: str, time: str, order: str, attribute: str) -> DataFrame:
    """(older, newer, n) of the values of ``attribute`` that follow each other in time within a group.

    Rows are first reduced to one per (group, value, time), so repeats don't count and a group holds as many rows as
    it has dates.
    """
    lean = rows.filter(F.col(time).isNotNull() & F.col(attribute).isNotNull()).groupBy(group, time, attribute).agg(F.min(order).alias("_o"))
    following = Window.partitionBy(group).orderBy(time, "_o")
    pairs = lean.select(F.lag(attribute).over(following).alias("older"), F.col(attribute).alias("newer"), (F.lag(time).over(following) < F.col(time)).alias("_later"))
    return pairs.filter("_later AND older <> newer").groupBy("older", "newer").agg(F.count(F.lit(1)).alias("n"))


#: How often a value must follow another for an edge of the precedence graph.
LEAST_TRANSITIONS = 3


def precedence_levels(counts: list[tuple[str, str, int]], least: int = LEAST_TRANSITIONS, ratio: float = 0.8) -> dict[str, int]:
    """Topological level of each value: the longest chain of values that precede it.

    An edge needs ``least`` transitions and ``ratio`` of those between its two values. Edges are added strongest
    first and one that would close a circle is left out, so the result is always an order.
    """
    seen = {(a, b): n for a, b, n in counts}
    edges = sorted(((n, a, b) for (a, b), n in seen.items() if n >= least and n >= ratio * (n + seen.get((b, a), 0))), key=lambda e: (-e[0], e[1], e[2]))
    after: dict[str, set[str]] = {}

    def reaches(a: str, b: str) -> bool:
        todo, met = [a], set()
        while todo:
            x = todo.pop()
            if x == b:
                return True
            if x not in met:
                met.add(x)
                todo += after.get(x, ())
        return False

    for _, a, b in edges:
        if not reaches(b, a):
            after.setdefault(a, set()).add(b)
    levels = {v: 0 for pair in seen for v in pair}
    for _ in range(len(levels)):
        moved = False
        for a, more in after.items():
            for b in more:
                if levels[b] <= levels[a]:
                    levels[b], moved = levels[a] + 1, True
        if not moved:
            break
    return levels


def with_currency(rows: DataFrame, group: str, time: str, order: str, attributes: list[str], learn_from: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``_time`` (known or inferred) and ``_after``: 1 later than that time, 0 at it, -1 inferred to be no later.

    A group without any known time has ``_time`` NULL and is ordered by level alone. Transitions are learned from
    ``learn_from``, else from the rows themselves; only those met as often as an edge asks reach the driver, and an
    attribute with more than ``MOST_EDGES`` of them raises ValueError. Where every row has its time there is nothing to
    infer and nothing is learned.
    """
    level: Column | None = None
    for attribute in attributes if not rows.filter(F.col(time).isNull()).isEmpty() else []:
        counts = transitions(rows if learn_from is None else learn_from, group, time, order, attribute).filter(F.col("n") >= LEAST_TRANSITIONS).limit(MOST_EDGES + 1).collect()
        if len(counts) > MOST_EDGES:
            raise ValueError(f"{attribute} has too many values that follow each other to order them")
        known = {v: k for v, k in precedence_levels([(r["older"], r["newer"], r["n"]) for r in counts]).items() if k}
        if known:
            table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
            own = F.coalesce(F.element_at(table, F.col(attribute)), F.lit(0))
            level = own if level is None else level + own
    rows = rows.withColumn("_level", F.lit(0) if level is None else level)
    anchors = rows.filter(F.col(time).isNotNull()).groupBy(group, "_level").agg(F.max(time).alias("_latest"))
    anchors = anchors.groupBy(group).agg(F.collect_list(F.struct("_level", "_latest")).alias("_anchors"))  # as many as there are levels
    untimed = rows.filter(F.col(time).isNull()).join(anchors, group, "left")
    below = F.filter(F.coalesce("_anchors", F.array().cast("array<struct<_level:int,_latest:timestamp>>")), lambda a: a["_level"] <= F.col("_level"))
    latest = F.array_max(F.transform(below, lambda a: F.struct(a["_latest"].alias("t"), a["_level"].alias("l"))))
    untimed = untimed.withColumn("_time", latest["t"]).withColumn("_after", F.when(F.col("_level") > latest["l"], 1).otherwise(-1)).drop("_anchors")
    timed = rows.filter(F.col(time).isNotNull()).withColumn("_time", F.col(time)).withColumn("_after", F.lit(0))
    return timed.unionByName(untimed)


def survivors(rows: DataFrame, group: str, order: str, fields: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(group, field, id of the row whose value survives), from rows with currency.

    ``fields`` gives of each field whether its value is usable, and its rank (less is better, NULL last). Ties end in
    the least ``order``. Groups without a usable value of a field have no row for it.
    """
    recency = (-F.coalesce(F.unix_micros("_time"), F.lit(-(1 << 62))), -F.col("_after"), -F.when(F.col("_after") != 0, F.col("_level")).otherwise(F.lit(0)))
    picks = [
        F.min(F.when(usable, F.struct(F.coalesce(rank, F.lit(1 << 30)).alias("r"), *[c.alias(f"t{k}") for k, c in enumerate(recency)], F.col(order).alias("id")))).alias(name)
        for name, (usable, rank) in fields.items()
    ]
    best = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"), *picks)
    long = F.array(*[F.struct(F.lit(name).alias("field"), F.col(f"{name}.id").alias("id")) for name in fields])
    return best.select(group, "n_rows", F.explode(long).alias("x")).filter("x.id IS NOT NULL").select(group, "n_rows", "x.field", "x.id")


def merged(rows: DataFrame, group: str, order: str, fields: dict[str, tuple[Column, Column]], values: list[str]) -> DataFrame:
    """One row per group: each of ``fields`` from its survivor, each of ``values`` from the latest row that has it."""
    recency = [-F.coalesce(F.unix_micros("_time"), F.lit(-(1 << 62))), -F.col("_after"), F.col(order)]
    best = lambda name, usable, first: F.min(F.when(usable, F.struct(*[c.alias(f"k{k}") for k, c in enumerate(first + recency)], F.col(name).alias("v"))))["v"].alias(name)
    picks = [best(name, usable, [F.coalesce(rank, F.lit(1 << 30))]) for name, (usable, rank) in fields.items()]
    picks += [best(name, F.col(name).isNotNull() & (F.trim(F.col(name).cast("string")) != ""), []) for name in values]
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"), F.min(order).alias("first_id"), *picks)


def ranked(rows: DataFrame, ranks: DataFrame, labels: dict[str, Column]) -> DataFrame:
    """``rows`` with ``_rank_<field>`` from the rank table, by broadcast: the table is fixed and small.

    Several ranks of one (field, source) count as their least.
    """
    small = ranks.groupBy("field", "source").agg(F.min("rank_hint").alias("rank_hint"))
    size = small.limit(10_001).count()

    def one(df: DataFrame, item: tuple[str, Column]) -> DataFrame:
        field, label = item
        own = small.filter(F.col("field") == field).select(F.col("source").alias("_label"), F.col("rank_hint").alias(f"_rank_{field}"))
        return df.withColumn("_label", label).join(F.broadcast(own) if size <= 10_000 else own, "_label", "left").drop("_label")

    return reduce(one, labels.items(), rows)
