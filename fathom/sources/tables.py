"""Readings, stations and water-surface points from CSV, with columns found by their aliases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.functions.text import folded_name, parsed_time

#: Accepted names of columns, the first that is there wins.
ALIASES = {
    "id": ("id", "punto", "nombre", "name", "station_id", "perfil"),
    "x": ("x", "e", "este", "easting", "east"),
    "y": ("y", "n", "norte", "northing", "north"),
    "h": ("h", "z", "cota", "elev", "elevation"),
    "river": ("rio", "river"),
    "station": ("station_id", "id_estacion", "estacion", "id"),
    "time": ("datetime", "fecha", "fecha_hora", "time"),
    "level": ("nivel", "level", "lectura"),
    "zero": ("gauge_zero", "cero", "cota_cero", "zero"),
    "name": ("name", "nombre"),
    "chainage": ("chainage", "progresiva"),
}


def resolved(columns: Sequence[str], want: str) -> str | None:
    """The column that an alias of ``want`` names, whatever its case."""
    lower = {c.strip().lower(): c for c in columns}
    return next((lower[a] for a in ALIASES[want] if a in lower), None)


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)


def _number(df: DataFrame, want: str) -> Column:
    found = resolved(df.columns, want)
    if found is None:
        return F.lit(None).cast("double")
    return F.expr(f"try_cast(replace(`{found}`, ',', '.') as double)")


def _text(df: DataFrame, want: str) -> Column:
    found = resolved(df.columns, want)
    return F.lit(None).cast("string") if found is None else F.nullif(F.trim(F.col(f"`{found}`")), F.lit(""))


def read_surface_points(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(points, rejected): id, x, y, h, river; rows without a place or a level are rejected with the reason."""
    raw = _csv(spark, path)
    missing = [w for w in ("x", "y", "h") if resolved(raw.columns, w) is None]
    if missing:
        raise ValueError(f"{path} has no column for {', '.join(missing)}")
    rows = raw.select(_text(raw, "id").alias("id"), *(_number(raw, w).alias(w) for w in ("x", "y", "h")), _text(raw, "river").alias("river"))
    reason = F.when(F.col("x").isNull() | F.col("y").isNull(), "no place").when(F.col("h").isNull(), "no level")
    rows = rows.withColumn("reason", reason)
    return rows.filter("reason is null").drop("reason"), rows.filter("reason is not null")


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Gauges with their reason of exclusion: the first that holds, or null for a usable one."""
    raw = _csv(spark, path)
    rows = raw.select(
        _text(raw, "station").alias("station_id"),
        _text(raw, "name").alias("name"),
        _text(raw, "river").alias("river"),
        *(_number(raw, w).alias(w) for w in ("zero", "x", "y", "chainage")),
    )
    reason = F.coalesce(
        F.when(F.col("station_id").isNull(), "no id"),
        F.when(F.col("zero").isNull(), "no gauge zero"),
        F.when(F.col("x").isNull() | F.col("y").isNull(), F.when(F.col("chainage").isNull(), "no place")),
    )
    return rows.withColumn("river_key", folded_name(F.col("river"))).withColumn("reason", reason)


def read_levels(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """(readings, mode): a series if any time parses and some station has several rows, else one mean a station."""
    raw = _csv(spark, path)
    found = resolved(raw.columns, "time")
    time = parsed_time(F.col(f"`{found}`")) if found else F.lit(None).cast("timestamp_ntz")
    rows = raw.select(_text(raw, "station").alias("station_id"), time.alias("ts"), _number(raw, "level").alias("level")).filter(
        "station_id is not null and level is not null"
    )
    counts = rows.groupBy("station_id").agg(F.count("*").alias("n"), F.count("ts").alias("timed"))
    most, timed = counts.agg(F.max("n"), F.sum("timed")).first()
    if timed and most > 1:
        return rows.filter("ts is not null"), "series"
    return rows.groupBy("station_id").agg(F.lit(None).cast("timestamp_ntz").alias("ts"), F.avg("level").alias("level")), "spot"
