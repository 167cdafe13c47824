"""Projection and well-known text as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 ellipsoid and the UTM grid constants.
_A = 6378137.0
_F = 1 / 298.257222101
_K0 = 0.9996
_FALSE_EASTING = 500000.0

# Kruger series to fourth order in the third flattening n.
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_ECC = 2 * math.sqrt(_N) / (1 + _N)

CRS_LONGLAT = "NAD83 longlat"


def crs_utm(zone: int = 12) -> str:
    return f"NAD83 UTM {zone}N"


def utm(lon: Column, lat: Column, zone: int = 12) -> tuple[Column, Column]:
    """NAD83 degrees -> (easting, northing) in metres; NULL in, NULL out."""
    dlon = F.radians(lon) - F.lit(math.radians(6 * zone - 183))
    sin_lat = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sin_lat) - F.lit(_ECC) * F.atanh(F.lit(_ECC) * sin_lat))
    xi = F.atan2(t, F.cos(dlon))
    eta = F.atanh(F.sin(dlon) / F.sqrt(t * t + F.lit(1.0)))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        k = F.lit(2.0 * j)
        east = east + F.lit(a) * F.cos(k * xi) * F.sinh(k * eta)
        north = north + F.lit(a) * F.sin(k * xi) * F.cosh(k * eta)
    scale = F.lit(_K0 * _RADIUS)
    return scale * east + F.lit(_FALSE_EASTING), scale * north


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    dx, dy = x1 - x0, y1 - y0
    return F.sqrt(dx * dx + dy * dy)


def point_wkt(x: Column, y: Column) -> Column:
    """``POINT (x y)``; NULL if either coordinate is missing."""
    return F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))
