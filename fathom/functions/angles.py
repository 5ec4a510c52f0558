"""Angles, projections and chainage as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def undirected_difference(a: Column, b: Column) -> Column:
    """Difference of two directions without sense, 0 to 90 degrees."""
    return F.abs(F.pmod(a - b + 90, F.lit(180.0)) - 90)


def azimuth(east: Column, north: Column) -> Column:
    """Clockwise from north, 0 to 360 degrees."""
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def along_axis(x: Column, y: Column, x0: Column, y0: Column, bearing: Column) -> tuple[Column, Column]:
    """(along, left offset) of a point relative to an origin and a bearing in degrees."""
    t = F.radians(bearing)
    dx, dy = x - x0, y - y0
    return dx * F.sin(t) + dy * F.cos(t), dy * F.sin(t) - dx * F.cos(t)


def offset_penalty(offset: Column, scale: float) -> Column:
    """Gaussian weight of a point's distance from the axis; 1 where the scale is not positive."""
    return F.exp(-0.5 * F.pow(F.abs(offset) / scale, 2)) if scale > 0 else F.lit(1.0)


def utm_zone(longitude: Column) -> Column:
    return (F.floor((longitude + 180) / 6) + 1).cast("int")


#: Fixed values of the WGS 84 ellipsoid.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563


def _series() -> tuple[float, list[float], float]:
    """Rectifying radius, forward series to the fourth power and eccentricity."""
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    ]
    return radius, forward, math.sqrt(FLATTENING * (2 - FLATTENING))


def transverse_mercator(
    longitude: Column, latitude: Column, meridian: Column, scale: float, east0: Column, north0: float
) -> tuple[Column, Column]:
    """(east, north) by the Krueger series; degrees in, metres out."""
    radius, forward, e = _series()
    lat, lon = F.radians(latitude), F.radians(longitude - meridian)
    t = F.sinh(F.atanh(F.sin(lat)) - e * F.atanh(e * F.sin(lat)))
    xi, eta = F.atan2(t, F.cos(lon)), F.asinh(F.sin(lon) / F.sqrt(t * t + F.cos(lon) * F.cos(lon)))
    north, east = xi, eta
    for k, a in enumerate(forward, 1):
        north = north + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        east = east + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    return east0 + scale * radius * east, F.lit(north0) + scale * radius * north


def inverse_series() -> tuple[list[float], list[float]]:
    """Coefficients of the Krueger series back, and of the latitude in terms of the conformal one, to the fourth power."""
    n = FLATTENING / (2 - FLATTENING)
    backward = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]
    conformal = [
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    ]
    return backward, conformal


def utm(longitude: Column, latitude: Column, zone: Column, south: Column | None = None) -> tuple[Column, Column]:
    """UTM, southern unless ``south`` says otherwise: scale 0.9996, false origin (500 km, 10 000 km in the south)."""
    east, north = transverse_mercator(longitude, latitude, zone * 6 - 183, 0.9996, F.lit(500_000.0), 10_000_000.0)
    return (east, north) if south is None else (east, north - F.when(south, 0.0).otherwise(10_000_000.0))


def belt(longitude: Column, latitude: Column, number: Column) -> tuple[Column, Column]:
    """National belt 1 to 7: three degrees wide, unit scale, origin at the south pole."""
    radius, _, _ = _series()
    east0 = number * 1_000_000.0 + 500_000.0
    return transverse_mercator(longitude, latitude, number * 3 - 75, 1.0, east0, radius * math.pi / 2)


def chainage_text(metres: Column) -> Column:
    """Metres as ``k+mmm.cc``, rounded to centimetres before splitting; null stays null."""
    cm = F.floor(F.abs(metres) * 100 + 0.5).cast("long")
    text = F.format_string(
        "%d+%03d.%02d", F.floor(cm / 100_000).cast("long"), F.pmod(F.floor(cm / 100), F.lit(1000)).cast("long"), F.pmod(cm, F.lit(100))
    )
    return F.when(metres.isNotNull(), F.concat(F.when((metres < 0) & (cm > 0), "-").otherwise(""), text))
