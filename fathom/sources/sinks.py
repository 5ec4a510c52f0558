"""Results as files: partitioned CSV and Parquet with geometry as well-known binary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _double_le(c: Column) -> Column:
    """A double's bytes, lowest first, as hex: by the bits of its sign, exponent and fraction."""
    v = F.coalesce(c.cast("double"), F.lit(float("nan")))
    a = F.abs(v)
    guess = F.floor(F.log2(F.when(a > 0, a).otherwise(F.lit(1.0)))).cast("int")
    e = guess + F.when(a >= F.pow(F.lit(2.0), guess + 1), 1).when(a < F.pow(F.lit(2.0), guess), -1).otherwise(0)
    fraction = ((a / F.pow(F.lit(2.0), e) - 1) * float(1 << 52)).cast("long")
    bits = F.shiftleft((e + 1023).cast("long"), 52).bitwiseOR(fraction)
    bits = F.when(a == 0, F.lit(0).cast("long")).when(F.isnan(v), F.lit(0x7FF8000000000000)).otherwise(bits)
    signed = F.when((v < 0) & ~F.isnan(v), bits.bitwiseOR(F.lit(-(1 << 63)))).otherwise(bits)
    big = F.lpad(F.hex(signed), 16, "0")
    return F.concat(*(F.substring(big, 15 - 2 * i, 2) for i in range(8)))


def point_wkb(x: Column, y: Column, z: Column | None = None) -> Column:
    """Little-endian well-known binary of a point, with height if given."""
    head = "0101000000" if z is None else "01E9030000"
    return F.unhex(F.concat(F.lit(head), *(_double_le(c) for c in (x, y, z) if c is not None)))


def line_wkb(*ends: tuple[Column, Column]) -> Column:
    """Little-endian well-known binary of a line through the given places."""
    head = "0102000000" + len(ends).to_bytes(4, "little").hex().upper()
    return F.unhex(F.concat(F.lit(head), *(_double_le(c) for place in ends for c in place)))


def write_csv(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """CSV with a header, split by the columns ``by``."""
    writer = df.write.mode("overwrite").option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_points(df: DataFrame, path: str, x: str, y: str, z: str | None = None) -> None:
    """Parquet with the columns and their place as ``geometry`` (well-known binary)."""
    df.withColumn("geometry", point_wkb(F.col(x), F.col(y), F.col(z) if z else None)).write.mode("overwrite").parquet(path)
