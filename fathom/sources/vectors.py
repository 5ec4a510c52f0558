"""Vector files: features as GeoJSON or well-known binary, centrelines and stations out of them.

Every geometry becomes ``shapes``: its members (lines, polygons or points), each a list of
rings or paths, each a list of places. GeoJSON is read and taken apart by Spark's own
functions; well-known binary is decoded in Arrow batches.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Accepted names of a centreline's and a station's attributes, the first that is there wins.
LINE_ALIASES = {"river": ("river", "rio", "río"), "role": ("role", "rol", "tipo"), "label": ("label", "etiqueta", "nombre", "name"), "flow": ("flow_dir", "flowdir", "sentido")}
STATION_ALIASES = {
    "station_id": ("station_id", "stationid", "id", "codigo", "código"), "name": ("name", "nombre"), "river": ("river", "rio", "río"),
    "zero": ("gauge_zero", "gaugezero", "cero", "cero_escala", "z0"), "chainage": ("chainage", "progresiva", "km"),
}
#: Texts that stand for a missing attribute; geometry types by their number in well-known binary.
MISSING = ("", "nan", "none", "null")
TYPES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}
SHAPES = "array<array<array<array<double>>>>"
FEATURE = "struct<geometry: struct<type: string, coordinates: string>, properties: map<string, string>>"


def read_geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(file, feature, attributes, kind, shapes) of feature collections, or of files with a feature a ``line``.

    A collection is one JSON text, so one task reads a file; large sets come as many files or
    as lines. Attribute names are lower-cased; features without a geometry, or with one of
    another kind, have null shapes.
    """
    if lines:
        raw = spark.read.schema("geometry struct<type: string, coordinates: string>, properties map<string, string>").json(path)
        rows = raw.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("feature"), "geometry", "properties")
    else:
        raw = spark.read.option("multiLine", True).schema(f"features array<{FEATURE}>").json(path)
        rows = raw.select(F.col("_metadata.file_path").alias("file"), F.posexplode("features").alias("feature", "f")).select("file", F.col("feature").cast("long"), "f.*")
    text, kind = F.col("geometry.coordinates"), F.col("geometry.type")
    place, path_, rings = (F.from_json(text, k) for k in ("array<double>", "array<array<double>>", "array<array<array<double>>>"))
    shapes = (
        F.when(kind == "Point", F.array(F.array(F.array(place))))
        .when(kind == "LineString", F.array(F.array(path_)))
        .when(kind == "Polygon", F.array(rings))
        .when(kind == "MultiPoint", F.transform(path_, lambda p: F.array(F.array(p))))
        .when(kind == "MultiLineString", F.transform(rings, lambda p: F.array(p)))
        .when(kind == "MultiPolygon", F.from_json(text, SHAPES))
    )
    attributes = F.transform_keys(F.coalesce("properties", F.create_map().cast("map<string,string>")), lambda k, _: F.lower(F.trim(k)))
    return rows.select("file", "feature", attributes.alias("attributes"), kind.alias("kind"), shapes.alias("shapes"))


def _decoded(data: bytes) -> tuple[str, list]:
    """(kind, shapes) of a geometry in well-known binary, with or without heights, measures and a system's number."""
    at = 0

    def take(form: str) -> tuple:
        nonlocal at
        out = struct.unpack_from(order + form, data, at)
        at += struct.calcsize(order + form)
        return out

    def head() -> tuple[int, int]:
        nonlocal at, order
        order = "<" if data[at] else ">"
        at += 1
        (code,) = take("I")
        if code & 0x20000000:
            take("I")
        size = 2 + bool(code & 0x80000000) + bool(code & 0x40000000) + (0, 1, 1, 2)[code % 10000 // 1000 if code < 0x10000000 else 0]
        return code & 0xFFFF if code >= 0x10000000 else code, size

    def places(n: int, size: int) -> list:
        nonlocal at
        out = np.frombuffer(data, f"{order}f8", n * size, at).reshape(n, size)[:, :2].tolist()
        at += 8 * n * size
        return out

    def member() -> list:
        code, size = head()
        kind = TYPES[code % 1000]
        if kind == "Point":
            return [[places(1, size)]]
        if kind == "LineString":
            return [[places(take("I")[0], size)]]
        if kind == "Polygon":
            return [[places(take("I")[0], size) for _ in range(take("I")[0])]]
        return [m for _ in range(take("I")[0]) for m in member()]

    order = "<"
    code, _ = head()
    at = 0
    return TYPES[code % 1000], member()


def from_wkb(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``kind`` and ``shapes`` of the well-known binary in ``column``; null where it can't be decoded."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, shapes = [], []
            for data in batch.column(names.index(column)).to_pylist():
                try:
                    kind, found = _decoded(data) if data else (None, None)
                except (struct.error, KeyError, ValueError, IndexError):
                    kind, found = None, None
                kinds.append(kind)
                shapes.append(found)
            nested = pa.float64()
            for _ in range(4):
                nested = pa.list_(nested)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kinds, pa.string()), pa.array(shapes, nested)], names=[*names, "kind", "shapes"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kinds}, kind string, shapes {SHAPES}")


def attribute(names: Sequence[str]) -> Column:
    """The first of a feature's attributes that is there under one of ``names``; null where it stands for a missing one."""
    value = F.coalesce(*(F.trim(F.try_element_at("attributes", F.lit(n))) for n in names))
    return F.when(~F.lower(value).isin(*MISSING), value)


def centrelines(features: DataFrame, default: str = "river") -> DataFrame:
    """Vertices of the line features, each line of a multiple one a part of its own: river, part, seq, x, y, role, label, flow."""
    lines = features.filter(F.col("kind").isin("LineString", "MultiLineString"))
    text = {k: attribute(v) for k, v in LINE_ALIASES.items()}
    rows = lines.select(
        F.coalesce(text["river"], F.lit(default)).alias("river"), F.lower(F.coalesce(text["role"], F.lit(""))).alias("role"),
        F.coalesce(text["label"], F.lit("")).alias("label"), F.upper(F.coalesce(text["flow"], F.lit(""))).alias("flow"),
        "file", "feature", F.posexplode("shapes").alias("piece", "line"),
    )
    part = F.concat_ws("-", F.element_at(F.split("file", "/"), -1), F.lpad(F.col("feature").cast("string"), 12, "0"), F.lpad(F.col("piece").cast("string"), 6, "0"))
    rows = rows.filter(F.size(F.get("line", F.lit(0))) > 1).withColumn("part", part)
    rows = rows.select("river", "part", "role", "label", "flow", F.posexplode(F.get("line", F.lit(0))).alias("seq", "at"))
    return rows.select("river", "part", "seq", F.get("at", F.lit(0)).alias("x"), F.get("at", F.lit(1)).alias("y"), "role", "label", "flow")


def interior_point(shapes: Column, kind: Column) -> Column:
    """Struct (x, y) inside a geometry: a point itself, the middle of a polygon's widest section, a line's vertex nearest to its centre.

    The section lies half-way between the places next above and below the middle of the
    polygon's height, and the widest of all members counts. A line's ends count only where it
    has no other vertex.
    """
    x, y = (lambda p: F.get(p, F.lit(0))), (lambda p: F.get(p, F.lit(1)))

    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def section(rings: Column) -> Column:
        heights = F.transform(F.flatten(rings), y)

        def at(h: Column) -> Column:
            middle = (F.array_min(h) + F.array_max(h)) / 2
            below, above = F.array_max(F.filter(h, lambda v: v <= middle)), F.array_min(F.filter(h, lambda v: v > middle))
            return let((F.coalesce(below, middle) + F.coalesce(above, middle)) / 2, across)

        def across(level: Column) -> Column:
            def crossing(a: Column, b: Column) -> Column:
                return F.when((y(a) <= level) != (y(b) <= level), x(a) + (level - y(a)) / (y(b) - y(a)) * (x(b) - x(a)))

            def of(ring: Column) -> Column:
                return F.zip_with(F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), crossing)

            met = F.array_sort(F.filter(F.flatten(F.transform(rings, of)), lambda v: v.isNotNull()))
            return let(met, lambda v: widest(v, level))

        def widest(met: Column, level: Column) -> Column:
            pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(met).cast("int") - 1, F.lit(1)), F.lit(2)), lambda i: F.struct((F.get(met, i) - F.get(met, i - 1)).alias("w"), ((F.get(met, i) + F.get(met, i - 1)) / 2).alias("x"), level.alias("y")))
            return F.array_max(F.filter(pairs, lambda p: p["w"].isNotNull()))

        return let(heights, at)

    best = F.array_max(F.transform(shapes, section))
    places = F.flatten(F.flatten(shapes))
    inner = F.flatten(F.transform(F.flatten(shapes), lambda p: F.when(F.size(p) > 2, F.slice(p, F.lit(2), F.size(p) - 2)).otherwise(F.array().cast("array<array<double>>"))))
    inner = F.when(F.size(inner) > 0, inner).otherwise(places)
    weighted = F.flatten(
        F.transform(
            F.flatten(shapes),
            lambda p: F.zip_with(
                F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))),
                lambda a, b: F.struct(F.hypot(x(b) - x(a), y(b) - y(a)).alias("w"), ((x(a) + x(b)) / 2).alias("x"), ((y(a) + y(b)) / 2).alias("y")),
            ),
        )
    )

    def total(rows: Column, value) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda acc, r: acc + value(r))

    def nearest(among: Column, cx: Column, cy: Column) -> Column:
        near = F.transform(among, lambda p: F.struct(F.hypot(x(p) - cx, y(p) - cy).alias("d"), x(p).alias("x"), y(p).alias("y")))
        return F.array_min(near)

    size = total(weighted, lambda r: r["w"])
    centre = let(F.struct((total(weighted, lambda r: r["w"] * r["x"]) / size).alias("x"), (total(weighted, lambda r: r["w"] * r["y"]) / size).alias("y")), lambda c: nearest(inner, c["x"], c["y"]))
    mean = let(F.struct((total(places, x) / F.size(places)).alias("x"), (total(places, y) / F.size(places)).alias("y")), lambda c: nearest(places, c["x"], c["y"]))
    point = lambda s: F.when(s.isNotNull(), F.struct(s["x"].alias("x"), s["y"].alias("y")))
    return F.when(kind.endswith("Polygon"), point(best)).when(kind.endswith("LineString"), point(centre)).when(kind.endswith("Point"), point(mean))


def stations(features: DataFrame) -> DataFrame:
    """Gauges of point, line and polygon features: station_id, name, river, zero, chainage, x, y; numbers that don't parse are null."""
    text = {k: attribute(v) for k, v in STATION_ALIASES.items()}
    number = lambda c: F.replace(c, F.lit(","), F.lit(".")).try_cast("double")
    place = interior_point(F.col("shapes"), F.col("kind"))
    rows = features.select(*(text[k].alias(k) for k in ("station_id", "name", "river")), *(number(text[k]).alias(k) for k in ("zero", "chainage")), place.alias("at"))
    return rows.select("station_id", "name", "river", "zero", "chainage", "at.x", "at.y")
