"""Distances on the earth, and bounds on the distance between two boxes."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The UDF travels with its code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EARTH_KM = 6371.0088  # mean radius
WGS84_A = 6378.137  # km
WGS84_F = 1 / 298.257223563
MAX_STEPS = 100

# The least radius of curvature on the ellipsoid: no line on it bends more sharply.
LEAST_RADIUS = WGS84_A * (1 - WGS84_F) ** 2
FAR_KM, MOST_KM = 12000.0, 20100.0  # beyond such a straight line only the greatest possible distance is sure
BLUR_KM = 1e-6  # rounding of positions and distances


# The spherical formulas are SQL text: scoring plans hold hundreds of such operations, and one
# parsed expression costs far less driver time than building them call by call.
def _arc(half_chord: str) -> str:
    return f"asin(sqrt(least({half_chord}, 1D))) * {2 * EARTH_KM!r}D"


def _sin2_half(degrees: str) -> str:
    half = f"sin(radians({degrees}) / 2)"
    return f"{half} * {half}"  # a product, not power(): that is several times slower


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance; NULL when a coordinate is NULL (``least`` would skip it)."""
    chord = f"({_sin2_half(f'{lat2} - {lat1}')} + cos(radians({lat1})) * cos(radians({lat2})) * {_sin2_half(f'{lon2} - {lon1}')})"
    known = " AND ".join(f"{x} IS NOT NULL" for x in (lat1, lon1, lat2, lon2))
    return f"CASE WHEN {known} THEN {_arc(chord)} END"


def inverse_km(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Inverse problem on WGS-84 after T. Vincenty, Survey Review 23(176), 1975."""
    f, a = WGS84_F, WGS84_A
    b = a * (1 - f)
    red1, red2 = (np.arctan((1 - f) * np.tan(np.radians(x))) for x in (lat1, lat2))
    sin1, cos1, sin2, cos2 = np.sin(red1), np.cos(red1), np.sin(red2), np.cos(red2)
    gap = np.radians(lon2 - lon1)
    lam = gap.copy()
    moving = np.isfinite(lam)
    with np.errstate(all="ignore"):
        for _ in range(MAX_STEPS):
            sin_l, cos_l = np.sin(lam), np.cos(lam)
            east, north = cos2 * sin_l, cos1 * sin2 - sin1 * cos2 * cos_l
            cross = np.sqrt(east * east + north * north)
            dot = sin1 * sin2 + cos1 * cos2 * cos_l
            sigma = np.arctan2(cross, dot)
            sin_az = np.where(cross == 0, 0.0, cos1 * east / cross)
            cos2_az = 1 - sin_az * sin_az
            mid = np.where(cos2_az == 0, 0.0, dot - 2 * sin1 * sin2 / cos2_az)
            if not moving.any():
                break
            c = f / 16 * cos2_az * (4 + f * (4 - 3 * cos2_az))
            turn = sigma + c * cross * (mid + c * dot * (2 * mid * mid - 1))
            new = gap + (1 - c) * f * sin_az * turn
            # Each element stops on its own, so a result never depends on its batch.
            step = np.abs(new - lam)
            lam = np.where(moving, new, lam)
            moving &= step > 1e-12
        u2 = cos2_az * (a * a - b * b) / (b * b)
        big_a = 1 + u2 / 16384 * (4096 + u2 * (u2 * (320 - 175 * u2) - 768))
        big_b = u2 / 1024 * (256 + u2 * (u2 * (74 - 47 * u2) - 128))
        inner = dot * (2 * mid * mid - 1) - big_b / 6 * mid * (4 * cross * cross - 3) * (4 * mid * mid - 3)
        km = b * big_a * (sigma - big_b * cross * (mid + big_b / 4 * inner))
    return np.where(moving, np.nan, km)


@F.pandas_udf(DoubleType())
def _vincenty_udf(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    cols = (s.to_numpy(dtype=float, na_value=np.nan) for s in (lat1, lon1, lat2, lon2))
    return pd.Series(inverse_km(*cols))


def distance_km(metric: str, lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Distance in km between two points given as column names; NULL on missing input.

    ``vincenty`` iterates to convergence in Arrow batches: unrolled as column expressions the
    steps grow past the JIT's method size, and a filter above inlines them into one another.
    """
    if metric == "vincenty":
        return F.nanvl(_vincenty_udf(lat1, lon1, lat2, lon2), F.lit(None).cast("double"))
    if metric == "haversine":
        return F.expr(haversine_sql(lat1, lon1, lat2, lon2))
    raise ValueError(f"unknown distance {metric!r}; use 'vincenty' or 'haversine'")


AXES = ("x", "y", "z")


def position(lat: str, lon: str, metric: str = "vincenty") -> dict[str, str]:
    """Point in space in km, as SQL per axis: on the sphere, or on the ellipsoid (by the reduced latitude).

    Straight lines between such points are never longer than the distance along the surface, differ
    little from it, and cost three products instead of a row of sines.
    """
    high = f"radians({lat})" if metric == "haversine" else f"atan({1 - WGS84_F!r}D * tan(radians({lat})))"
    wide, tall = (EARTH_KM, EARTH_KM) if metric == "haversine" else (WGS84_A, WGS84_A * (1 - WGS84_F))
    return {
        "x": f"coalesce(cos({high}) * cos(radians({lon})) * {wide!r}D, 0D)",
        "y": f"coalesce(cos({high}) * sin(radians({lon})) * {wide!r}D, 0D)",
        "z": f"coalesce(sin({high}) * {tall!r}D, 0D)",
    }


def positions(metric: str, lat: np.ndarray, lon: np.ndarray) -> list[np.ndarray]:
    """``position`` of known coordinates, as one array per axis."""
    high = np.radians(lat) if metric == "haversine" else np.arctan((1 - WGS84_F) * np.tan(np.radians(lat)))
    wide, tall = (EARTH_KM, EARTH_KM) if metric == "haversine" else (WGS84_A, WGS84_A * (1 - WGS84_F))
    across = np.cos(high) * wide
    return [across * np.cos(np.radians(lon)), across * np.sin(np.radians(lon)), np.sin(high) * tall]


def _radius(metric: str) -> float:
    """No line along the surface bends more sharply than a circle of this radius, so none is longer than its arc."""
    return EARTH_KM if metric == "haversine" else LEAST_RADIUS


def most_km(metric: str, chord: np.ndarray) -> np.ndarray:
    """At least the distance of points a straight line ``chord`` apart."""
    wide = 2 * _radius(metric)
    return np.where(chord > FAR_KM, MOST_KM, np.arcsin(np.minimum(1, chord / wide)) * wide) + BLUR_KM


def least_km(chord: np.ndarray) -> np.ndarray:
    """At most the distance of points a straight line ``chord`` apart."""
    return np.maximum(0, chord - BLUR_KM)


def least_chord(metric: str, km: np.ndarray) -> np.ndarray:
    """Points at least ``km`` apart are no nearer than this by a straight line."""
    wide = 2 * _radius(metric)
    return np.minimum(FAR_KM, np.sin(np.clip((km - BLUR_KM) / wide, 0, math.pi / 2)) * wide) - BLUR_KM


def chord_sql(gaps: list[str]) -> str:
    """Length of a straight line from its three axis parts."""
    return "sqrt(" + " + ".join(f"({g}) * ({g})" for g in gaps) + ")"


def axis_gap(a: str, c: str, name: str) -> str:
    """Least difference between two ranges ``<prefix><name>_lo`` .. ``_hi``."""
    return f"greatest(0D, {c}{name}_lo - {a}{name}_hi, {a}{name}_lo - {c}{name}_hi)"


def box_km_bounds(a: str, c: str, metric: str) -> tuple[str, str]:
    """Least and greatest possible distance between two boxes of positions, as SQL.

    ``a`` and ``c`` are prefixes of the columns ``x_lo, x_hi, ...``.
    """
    least = chord_sql([axis_gap(a, c, x) for x in AXES])
    most = chord_sql([f"greatest({c}{x}_hi - {a}{x}_lo, {a}{x}_hi - {c}{x}_lo)" for x in AXES])
    wide = 2 * _radius(metric)
    arc = f"if({most} > {FAR_KM!r}D, {MOST_KM!r}D, asin(least(1D, {most} / {wide!r}D)) * {wide!r}D)"
    return f"greatest(0D, {least} - {BLUR_KM!r}D)", f"{arc} + {BLUR_KM!r}D"


def box_km_by_degrees(a: str, c: str, metric: str) -> tuple[str, str]:
    """Least and greatest possible distance between two boxes of coordinates (``lat_lo, lat_hi, ...``), as SQL.

    On a sphere the distance grows with the difference in latitude, in longitude (up to half a turn) and with
    the parallels' widths. The ellipsoid is within one percent of it.
    """
    stray = 0.01 if metric == "vincenty" else 1e-9
    rise, across = axis_gap(a, c, "lat"), f"greatest({c}lon_hi - {a}lon_lo, {a}lon_hi - {c}lon_lo)"
    turn = f"least({axis_gap(a, c, 'lon')}, greatest(0D, 360 - {across}))"  # or the other way round
    climb = f"greatest({c}lat_hi - {a}lat_lo, {a}lat_hi - {c}lat_lo)"
    swing = f"least(180D, {across})"
    thin = " * ".join(f"cos(radians(greatest(abs({p}lat_lo), abs({p}lat_hi))))" for p in (a, c))
    wide = " * ".join(f"cos(radians(if({p}lat_lo <= 0 AND {p}lat_hi >= 0, 0D, least(abs({p}lat_lo), abs({p}lat_hi)))))" for p in (a, c))
    least = _arc(f"({_sin2_half(rise)} + {thin} * {_sin2_half(turn)})")
    most = _arc(f"({_sin2_half(f'least(180D, {climb})')} + {wide} * {_sin2_half(swing)})")
    known = f"greatest(abs({a}lat_lo), abs({a}lat_hi), abs({c}lat_lo), abs({c}lat_hi)) <= 90 AND greatest(abs({a}lon_lo), abs({a}lon_hi), abs({c}lon_lo), abs({c}lon_hi)) <= 180"
    return f"if({known}, {least} * {1 - stray!r}D, 0D)", f"if({known}, {most} * {1 + stray!r}D, double('inf'))"
