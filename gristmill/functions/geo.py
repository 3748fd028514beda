"""Points on the globe: reading them from text, distances, grid cells."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import let

EARTH_RADIUS_M = 6_371_000.0

#: Bounds within which a point is taken as one of the country (fixed values).
LAT_RANGE = (41.0, 51.5)
LON_RANGE = (-5.5, 10.0)


def coordinate(text: Column) -> Column:
    """A coordinate from text: blanks off, a decimal comma as a point; anything else, 'nan' too, is NULL."""
    return let(decimal(text), lambda x: F.when(~F.isnan(x), x))


def decimal(text: Column) -> Column:
    """A number from text: blanks off, a decimal comma as a point; 'nan' stays."""
    return F.regexp_replace(F.regexp_replace(text, r"[\s\xa0]+", ""), ",", ".").try_cast("double")


def located(lat: Column, lon: Column) -> Column:
    """STRUCT(lat, lon) of a pair of texts, NULL where it is no point within the bounds.

    A pair standing in each other's fields is turned the right way round.
    """
    return let(F.struct(coordinate(lat).alias("a"), coordinate(lon).alias("b")), lambda p: _placed(p["a"], p["b"]))


def _placed(a: Column, b: Column) -> Column:
    right = a.between(*LAT_RANGE) & b.between(*LON_RANGE)
    turned = b.between(*LAT_RANGE) & a.between(*LON_RANGE)
    return F.when(right, F.struct(a.alias("lat"), b.alias("lon"))).when(turned, F.struct(b.alias("lat"), a.alias("lon")))


def located_np(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``located`` over arrays of ``decimal``: (lat, lon), NaN where the pair is no point within the bounds."""
    within = lambda x, bounds: (x >= bounds[0]) & (x <= bounds[1])
    right, turned = within(a, LAT_RANGE) & within(b, LON_RANGE), within(b, LAT_RANGE) & within(a, LON_RANGE)
    return np.where(right, a, np.where(turned, b, np.nan)), np.where(right, b, np.where(turned, a, np.nan))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return F.asin(F.sqrt(F.least(half, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def haversine_np(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """``haversine_m`` over arrays."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    half = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(half, 1.0)))


def grid_cell(lat: Column, lon: Column, lat_step: float = 0.0009, lon_step: float = 0.0012) -> tuple[Column, Column]:
    """Cell of about 100 m, halves rounded to even."""
    return F.bround(lat / lat_step).cast("bigint"), F.bround(lon / lon_step).cast("bigint")
