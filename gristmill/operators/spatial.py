"""Points near other points: a partitioned spatial join.

1. A bounded sample of both sides builds a quadtree on the driver; its leaves are ranges of Morton codes.
2. Every build point goes to the one leaf it lies in, every probe point to each leaf that its search box touches.
3. Each leaf bulk-loads an R-tree (sort-tile-recursive) over its build points and probes it with whole arrays.
4. Candidates are refined with the great-circle distance.
5. The reference point of a pair is its build point: it lies in one leaf only, so no pair is given twice.

Both sides are reduced to distinct coordinates before and expanded after, so a place that a third of all rows share
is one point in the tree. A leaf with more than a twentieth of the sample is cut into ``blocks`` by hash, and each pair
of blocks is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.geo import EARTH_RADIUS_M, haversine_np

CODE_BITS = 24


class Quadtree:
    """Leaves over the unit square as sorted starts of Morton codes."""

    def __init__(self, starts: np.ndarray, bounds: tuple[float, float, float, float]):
        self.starts = starts
        self.bounds = bounds

    @staticmethod
    def _spread(v: np.ndarray) -> np.ndarray:
        v = v.astype(np.uint64)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = (v | (v << np.uint64(shift))) & np.uint64(mask)
        return v

    @classmethod
    def code(cls, lat: np.ndarray, lon: np.ndarray, bounds: tuple[float, float, float, float]) -> np.ndarray:
        south, west, north, east = bounds
        side = 1 << CODE_BITS
        y = np.clip((lat - south) / (north - south) * side, 0, side - 1).astype(np.int64)
        x = np.clip((lon - west) / (east - west) * side, 0, side - 1).astype(np.int64)
        return (cls._spread(y) << np.uint64(1)) | cls._spread(x)

    @classmethod
    def build(cls, lat: np.ndarray, lon: np.ndarray, leaves: int, radius_m: float) -> "Quadtree":
        """At most about ``leaves`` leaves, none smaller than twice the radius."""
        south, north = (lat.min(), lat.max()) if len(lat) else (0.0, 1.0)
        west, east = (lon.min(), lon.max()) if len(lon) else (0.0, 1.0)
        bounds = (float(south), float(west), float(max(north, south + 1e-3)), float(max(east, west + 1e-3)))
        dlat, dlon = box_degrees(np.array([max(abs(bounds[0]), abs(bounds[2]))]), radius_m)
        depth = int(max(0, min(CODE_BITS, np.floor(np.log2(min((bounds[2] - bounds[0]) / (2.01 * dlat), (bounds[3] - bounds[1]) / (2.01 * dlon[0])))))))
        codes = np.sort(cls.code(lat, lon, bounds))
        most = max(1, -(-len(codes) // max(1, leaves)))
        starts, todo = [], [(0, 0, 0, len(codes))]
        while todo:
            start, level, a, b = todo.pop()
            if b - a <= most or level >= depth:
                starts.append(start)
                continue
            quarter = 1 << (2 * (CODE_BITS - level - 1))
            cuts = [a, *np.searchsorted(codes[a:b], np.array([start + quarter * k for k in (1, 2, 3)], dtype=np.uint64)) + a, b]
            todo += [(start + quarter * k, level + 1, int(cuts[k]), int(cuts[k + 1])) for k in range(4)]
        return cls(np.array(sorted(starts), dtype=np.uint64), bounds)

    def leaf(self, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, self.code(lat, lon, self.bounds), side="right") - 1


def box_degrees(lat: np.ndarray, radius_m: float) -> tuple[float, np.ndarray]:
    """Half sides, in degrees, of boxes that hold the circle around points at ``lat``."""
    dlat = np.degrees(radius_m / EARTH_RADIUS_M) * 1.000001
    widest = np.minimum(np.abs(lat) + dlat, 89.9)
    return dlat, np.degrees(radius_m / EARTH_RADIUS_M / np.cos(np.radians(widest))) * 1.000001


class PackedRTree:
    """R-tree over points, bulk-loaded by sort-tile-recursive packing, probed with arrays of boxes."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, fanout: int = 32):
        n = len(lat)
        pages = max(1, -(-n // fanout))
        strips = max(1, int(np.ceil(np.sqrt(pages))))
        by_lon = np.argsort(lon, kind="stable")
        strip = np.empty(n, dtype=np.int64)
        strip[by_lon] = np.arange(n) // max(1, -(-n // strips))
        self.order = np.lexsort((lat, strip))
        self.lat, self.lon, self.fanout = lat[self.order], lon[self.order], fanout
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        low = (self.lat, self.lon, self.lat, self.lon)
        while True:
            cut = np.arange(0, len(low[0]), fanout)
            low = tuple(f.reduceat(x, cut) for f, x in zip((np.minimum, np.minimum, np.maximum, np.maximum), low))
            self.levels.append(low)
            if len(cut) <= 1:
                break

    def probe(self, south: np.ndarray, west: np.ndarray, north: np.ndarray, east: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probe index, point index) of the points inside each box."""
        who, node = np.arange(len(south)), np.zeros(len(south), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            s, w, n, e = self.levels[k]
            keep = (s[node] <= north[who]) & (n[node] >= south[who]) & (w[node] <= east[who]) & (e[node] >= west[who])
            who, node = who[keep], node[keep]
            width = len(self.levels[k - 1][0]) if k else len(self.lat)
            child = (node[:, None] * self.fanout + np.arange(self.fanout)[None, :]).ravel()
            who = np.repeat(who, self.fanout)
            inside = child < width
            who, node = who[inside], child[inside]
        keep = (self.lat[node] <= north[who]) & (self.lat[node] >= south[who]) & (self.lon[node] <= east[who]) & (self.lon[node] >= west[who])
        return who[keep], self.order[node[keep]]


def pairs_within(build: tuple[np.ndarray, np.ndarray], probe: tuple[np.ndarray, np.ndarray], radius_m: float, chunk: int = 20_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(probe index, build index, metres) of all pairs within the radius, in chunks of probes."""
    if not len(build[0]):
        return
    tree = PackedRTree(*build)
    for at in range(0, len(probe[0]), chunk):
        lat, lon = probe[0][at : at + chunk], probe[1][at : at + chunk]
        dlat, dlon = box_degrees(lat, radius_m)
        who, what = tree.probe(lat - dlat, lon - dlon, lat + dlat, lon + dlon)
        metres = haversine_np(lat[who], lon[who], build[0][what], build[1][what])
        near = metres <= radius_m
        yield who[near] + at, what[near], metres[near]


def sample_points(points: DataFrame, most: int) -> pd.DataFrame:
    """About ``most`` distinct points at the most, all of them where there are no more rows than that.

    Rows are counted first and kept by a threshold on a hash of the point, so no partition sends more than its part.
    """
    n = points.count()
    chosen = F.pmod(F.xxhash64("lat", "lon"), F.lit(1 << 30)) < F.lit(int((1 << 30) * most / max(n, 1)))
    return (points if n <= most else points.filter(chosen)).select("lat", "lon").distinct().toPandas()


def distance_join(probe: DataFrame, build: DataFrame, radius_m: float, sample_rows: int = 20_000, blocks: int = 8, leaves: int | None = None) -> DataFrame:
    """Every (probe row, build row) whose points lie within ``radius_m``, with ``distance_m``.

    Both sides carry DOUBLE columns ``lat`` and ``lon`` in degrees and any other columns under names that don't clash;
    rows with a NULL or NaN coordinate match nothing, repeated rows each give their pairs, an empty side gives none.
    ``sample_rows`` (half from each side) bounds what reaches the driver, 16 bytes a point. Not for regions across the 180th meridian.
    """
    spark = probe.sparkSession
    leaves = leaves or max(8, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    valid = "lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)"
    probe_points = probe.filter(valid).select("lat", "lon").distinct()
    build_points = build.filter(valid).select("lat", "lon").distinct()
    sampled = pd.concat([sample_points(side.filter(valid), sample_rows // 2) for side in (probe, build)])
    tree = Quadtree.build(sampled["lat"].to_numpy(), sampled["lon"].to_numpy(), leaves, radius_m)

    def to_leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(leaf=tree.leaf(b["lat"].to_numpy(), b["lon"].to_numpy()).astype(np.int64))

    def to_leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lat, lon = b["lat"].to_numpy(), b["lon"].to_numpy()
            dlat, dlon = box_degrees(lat, radius_m)
            corners = np.stack([tree.leaf(lat + s * dlat, lon + w * dlon) for s in (-1, 1) for w in (-1, 1)], axis=1)
            corners.sort(axis=1)
            fresh = np.concatenate([np.ones((len(lat), 1), bool), corners[:, 1:] != corners[:, :-1]], axis=1)
            row, col = np.nonzero(fresh)
            yield pd.DataFrame({"lat": lat[row], "lon": lon[row], "leaf": corners[row, col].astype(np.int64)})

    shape = "lat double, lon double, leaf bigint"
    placed_build, placed_probe = build_points.mapInPandas(to_leaf, shape), probe_points.mapInPandas(to_leaves, shape)

    # Blocks of a crowded leaf: known from the sample's share of each leaf, at most one entry per leaf.
    counts = np.bincount(tree.leaf(sampled["lat"].to_numpy(), sampled["lon"].to_numpy()), minlength=len(tree.starts)) if len(sampled) else np.zeros(1, int)
    crowded = [int(k) for k in np.nonzero(counts > max(16, 0.05 * len(sampled)))[0]]

    def blocked(df: DataFrame, own: str, other: str) -> DataFrame:
        hot = F.col("leaf").isin(crowded) if crowded else F.lit(False)
        # of one type on both sides: keys of different types hash to different partitions and never meet
        df = df.withColumn(own, F.when(hot, F.pmod(F.xxhash64("lat", "lon"), F.lit(blocks))).otherwise(F.lit(0)).cast("int"))
        return df.withColumn(other, F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(blocks - 1))).otherwise(F.array(F.lit(0)))))

    def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["p_lat", "p_lon", "b_lat", "b_lon", "distance_m"]
        if not len(left) or not len(right):
            return pd.DataFrame({c: np.empty(0) for c in columns})
        p = left["lat"].to_numpy(), left["lon"].to_numpy()
        b = right["lat"].to_numpy(), right["lon"].to_numpy()
        parts = [(p[0][i], p[1][i], b[0][j], b[1][j], d) for i, j, d in pairs_within(b, p, radius_m)]
        return pd.DataFrame({c: np.concatenate([x[k] for x in parts]) for k, c in enumerate(columns)})

    task = ["leaf", "bi", "pi"]
    left = blocked(placed_probe, "pi", "bi").groupBy(*task)
    right = blocked(placed_build, "bi", "pi").groupBy(*task)
    near = left.cogroup(right).applyInPandas(match, "p_lat double, p_lon double, b_lat double, b_lon double, distance_m double")
    with_build = near.join(build.withColumnsRenamed({"lat": "b_lat", "lon": "b_lon"}), ["b_lat", "b_lon"])
    return with_build.join(probe.withColumnsRenamed({"lat": "p_lat", "lon": "p_lon"}), ["p_lat", "p_lon"]).drop("p_lat", "p_lon", "b_lat", "b_lon")
