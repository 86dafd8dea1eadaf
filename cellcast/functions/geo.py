"""Projection and distance column maths.

Written as native column expressions so they stay inside whole-stage codegen;
no geometry library is needed.  The Albers constants are those of the public
EPSG:3310 definition (see ``fixed_values.ALBERS``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellcast.fixed_values import ALBERS

_A = ALBERS["a"]
_F = 1.0 / ALBERS["inv_f"]
_E2 = 2 * _F - _F * _F
_E = math.sqrt(_E2)


def _q_py(phi: float) -> float:
    s = math.sin(phi)
    return (1 - _E2) * (s / (1 - _E2 * s * s) - (1 / (2 * _E)) * math.log((1 - _E * s) / (1 + _E * s)))


def _m_py(phi: float) -> float:
    s = math.sin(phi)
    return math.cos(phi) / math.sqrt(1 - _E2 * s * s)


_PHI1 = math.radians(ALBERS["lat1"])
_PHI2 = math.radians(ALBERS["lat2"])
_PHI0 = math.radians(ALBERS["lat0"])
_LAM0 = math.radians(ALBERS["lon0"])
_M1, _M2 = _m_py(_PHI1), _m_py(_PHI2)
_Q0, _Q1, _Q2 = _q_py(_PHI0), _q_py(_PHI1), _q_py(_PHI2)
_N = (_M1 * _M1 - _M2 * _M2) / (_Q2 - _Q1)
_C = _M1 * _M1 + _N * _Q1
_RHO0 = _A * math.sqrt(_C - _N * _Q0) / _N
_FE = ALBERS["false_easting"]
_FN = ALBERS["false_northing"]


def _q(sin_phi: Column) -> Column:
    return F.lit(1 - _E2) * (
        sin_phi / (F.lit(1.0) - F.lit(_E2) * sin_phi * sin_phi)
        - F.lit(1 / (2 * _E)) * F.log((F.lit(1.0) - F.lit(_E) * sin_phi) / (F.lit(1.0) + F.lit(_E) * sin_phi))
    )


def albers_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """F14 forward: degrees (EPSG:4326) -> metres (EPSG:3310)."""
    sin_phi = F.sin(F.radians(lat))
    rho = F.lit(_A) * F.sqrt(F.lit(_C) - F.lit(_N) * _q(sin_phi)) / F.lit(_N)
    theta = F.lit(_N) * (F.radians(lon) - F.lit(_LAM0))
    x = F.lit(_FE) + rho * F.sin(theta)
    y = F.lit(_FN) + F.lit(_RHO0) - rho * F.cos(theta)
    return x, y


def albers_inverse(
    df: DataFrame, x_col: str, y_col: str, lon_out: str = "lon", lat_out: str = "lat", iterations: int = 6
) -> DataFrame:
    """F14 inverse: metres -> degrees; latitude by a fixed number of Newton steps.

    Each step is its own projection so the latitude expression is referenced,
    not copied, by the next step (a nested expression would grow as 4^steps).
    """
    dx = F.col(x_col) - F.lit(_FE)
    dy = F.lit(_RHO0) - (F.col(y_col) - F.lit(_FN))
    rho = F.sqrt(dx * dx + dy * dy)
    out = df.withColumn("_theta", F.atan2(dx, dy)).withColumn(
        "_q", (F.lit(_C) - rho * rho * F.lit(_N * _N) / F.lit(_A * _A)) / F.lit(_N)
    )
    out = out.withColumn("_phi", F.asin(F.col("_q") / F.lit(2.0)))
    for _ in range(iterations):
        phi = F.col("_phi")
        s = F.sin(phi)
        one = F.lit(1.0) - F.lit(_E2) * s * s
        out = out.withColumn(
            "_phi",
            phi
            + one * one / (F.lit(2.0) * F.cos(phi))
            * (
                F.col("_q") / F.lit(1 - _E2)
                - s / one
                + F.lit(1 / (2 * _E)) * F.log((F.lit(1.0) - F.lit(_E) * s) / (F.lit(1.0) + F.lit(_E) * s))
            ),
        )
    out = out.withColumn(lon_out, F.degrees(F.lit(_LAM0) + F.col("_theta") / F.lit(_N)))
    out = out.withColumn(lat_out, F.degrees(F.col("_phi")))
    return out.drop("_theta", "_q", "_phi")


def albers_xy_py(lon: float, lat: float) -> tuple[float, float]:
    """Plain-Python forward projection (tests and small driver-side checks)."""
    phi = math.radians(lat)
    rho = _A * math.sqrt(_C - _N * _q_py(phi)) / _N
    theta = _N * (math.radians(lon) - _LAM0)
    return _FE + rho * math.sin(theta), _FN + _RHO0 - rho * math.cos(theta)


MAX_MERCATOR_LATITUDE = 85.0511287798
EARTH_RADIUS = 6378137.0


def web_mercator_pixel(lat: Column, lon: Column, zoom: int | Column) -> tuple[Column, Column]:
    """pixel coordinates of a point at a zoom level (256-pixel tiles)."""
    z = zoom if isinstance(zoom, Column) else F.lit(zoom)
    scale = F.lit(256.0) * F.pow(F.lit(2.0), z)
    clamped = F.greatest(F.least(lat, F.lit(MAX_MERCATOR_LATITUDE)), F.lit(-MAX_MERCATOR_LATITUDE))
    s = F.sin(F.radians(clamped))
    merc_y = F.lit(EARTH_RADIUS) * F.log((F.lit(1.0) + s) / (F.lit(1.0) - s)) / F.lit(2.0)
    merc_x = F.lit(EARTH_RADIUS) * F.radians(lon)
    k = F.lit(0.5 / (math.pi * EARTH_RADIUS))
    px = scale * (k * merc_x + F.lit(0.5))
    py = scale * (F.lit(-1.0) * k * merc_y + F.lit(0.5))
    return px, py


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """F16: Euclidean distance (metres in a projected system)."""
    return F.hypot(x1 - x2, y1 - y2)
