"""Which reference system results are written in."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from fathom.functions import angles

#: Projected systems in metres by EPSG code: UTM on WGS 84, north and south; the national belts of two frames.
METRIC = (range(32601, 32661), range(32701, 32761), range(5343, 5350), range(22181, 22188))
#: Fixed value: the system taken where none is declared (belt 2).
FALLBACK = 5344


def is_metric(epsg: int | None) -> bool:
    """Whether the code is one of the known projected systems with metres as unit."""
    return epsg is not None and any(epsg in codes for codes in METRIC)


def output_system(asked: int | None, network: int | None) -> tuple[int, str]:
    """(code, where it comes from): the one asked for, else the network's, else the fallback; it must be metric."""
    code, why = (asked, "asked for") if asked else (network, "network") if network else (FALLBACK, "fallback")
    if not is_metric(code):
        raise ValueError(f"EPSG:{code} ({why}) is not a projected system in metres")
    return code, why


def _parameters(epsg: Column) -> tuple[Column, Column, Column, Column]:
    """(meridian, scale, false east, false north) of a projected system by its code; null for others."""
    north, south = epsg.between(32601, 32660), epsg.between(32701, 32760)
    belt = F.when(epsg.between(5343, 5349), epsg - 5342).when(epsg.between(22181, 22187), epsg - 22180)
    radius, _, _ = angles._series()
    meridian = F.when(north | south, epsg % 100 * 6 - 183).when(belt.isNotNull(), belt * 3 - 75)
    scale = F.when(north | south, 0.9996).when(belt.isNotNull(), 1.0)
    east = F.when(north | south, 500_000.0).when(belt.isNotNull(), belt * 1_000_000.0 + 500_000.0)
    return meridian, scale, east, F.when(north, 0.0).when(south, 10_000_000.0).when(belt.isNotNull(), radius * math.pi / 2)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it.

    Plain expressions would be repeated at every mention, some ten times in each step of a
    series, and once more wherever a filter is pushed through them.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def projected(longitude: Column, latitude: Column, epsg: Column) -> Column:
    """Struct (x, y) in the metric system ``epsg``; nulls in other systems."""

    def body(p: Column) -> Column:
        meridian, scale, east, north = (p[c] for c in ("m", "k", "e", "n"))
        x, y = angles.transverse_mercator(p["lon"], p["lat"], meridian, scale, east, north)
        return F.struct(x.alias("x"), y.alias("y"))

    named = zip(_parameters(epsg), ("m", "k", "e", "n"))
    return _let(F.struct(longitude.alias("lon"), latitude.alias("lat"), *(c.alias(n) for c, n in named)), body)


def unprojected(x: Column, y: Column, epsg: Column) -> Column:
    """Struct (lon, lat) of a place in the metric system ``epsg``, by the Krueger series back; nulls in other systems."""
    meridian, scale, east, north = _parameters(epsg)
    radius, _, _ = angles._series()
    backward, conformal = angles.inverse_series()
    size = scale * radius

    def rectified(p: Column) -> Column:
        xi, eta, a, b = p["xi"], p["eta"], p["xi"], p["eta"]
        for k, c in enumerate(backward, 1):
            a = a - c * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
            b = b - c * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        return _let(F.struct(a.alias("a"), b.alias("b"), p["m"].alias("m")), sphere)

    def sphere(p: Column) -> Column:
        sine = F.sin(p["a"]) / F.cosh(p["b"])
        chi = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sine)))
        return _let(F.struct(chi.alias("chi"), (p["m"] + F.degrees(F.atan2(F.sinh(p["b"]), F.cos(p["a"])))).alias("lon")), place)

    def place(p: Column) -> Column:
        latitude = p["chi"]
        for k, c in enumerate(conformal, 1):
            latitude = latitude + c * F.sin(2 * k * p["chi"])
        return F.struct(p["lon"].alias("lon"), F.when(p["lon"].isNotNull(), F.degrees(latitude)).alias("lat"))

    return _let(F.struct(((y - north) / size).alias("xi"), ((x - east) / size).alias("eta"), meridian.alias("m")), rectified)


def reprojected(x: Column, y: Column, source: Column, target: Column) -> Column:
    """Struct (x, y) of a place in another metric system; unchanged within the same one. The frames count as one (WGS 84)."""
    there = _let(unprojected(x, y, source), lambda p: projected(p["lon"], p["lat"], target))
    return F.when(source == target, F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))).otherwise(there)
