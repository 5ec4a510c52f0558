"""Point clouds with dense numbers, their tables, and runs that are written and counted in one pass."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fathom.functions.materialise import cut

#: Bits of Spark's row numbers that count within a partition.
PLACE_BITS = 33
#: Columns of a cloud of tracks, in their order.
TRACK_COLUMNS = (
    "pt_id", "file", "class", "ens", "beam_id", "beam_type", "src", "freq_khz", "depth", "ws_elev", "ws_src", "bed_elev", "river", "brazo",
    "km_ofic", "off_axis", "dist_axis", "t_utc", "spike", "flag", "x_out", "y_out",
)
#: Columns of the table of water-surface values, in their order, and decimals of its numbers.
QC_COLUMNS = ("kind", "id", "river", "km_internal_m", "km_oficial_m", "dist_axis_m", "alt_river", "alt_dist_m", "elev_m", "role", "note", "x", "y")
QC_DECIMALS = {"km_internal_m": 2, "km_oficial_m": 2, "dist_axis_m": 1, "alt_dist_m": 1, "elev_m": 3, "x": 3, "y": 3}


def numbered(df: DataFrame, order: Sequence[str], out: str = "pt_id", first: int = 0, partitions: int | None = None) -> DataFrame:
    """``df`` with the numbers ``first``, ``first`` + 1, ... in the given order, which should tell rows apart.

    Rows are dealt out by ranges of the order, sorted and materialised; a partition's numbers
    begin after the rows of those before it. So no task sees more than its own range, the
    driver only the partitions' sizes, and a lost executor's rows get the same numbers again.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    mark = rows.withColumn("__at", F.monotonically_increasing_id())
    part = F.shiftright("__at", PLACE_BITS)
    total, begins = first, []
    for k, size in sorted(tuple(r) for r in mark.groupBy(part.alias("part")).count().collect()):
        begins.append((k, total))
        total += size
    starts = df.sparkSession.createDataFrame(begins, "__part long, __begin long")
    place = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    met = mark.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return met.select((F.col("__begin") + place).alias(out), *df.columns)


def track_cloud(points: DataFrame, order: Sequence[str] = ("file", "ens", "beam_index")) -> DataFrame:
    """The cloud of all tracks, numbered from 0, with TRACK_COLUMNS.

    ``points`` has the columns but for pt_id, beam_id, beam_type, src and freq_khz, and
    beam_index (0: the vertical beam), source (2: the vertical beam's) and khz. Columns
    that are not there are null.
    """
    beam = F.col("beam_index")
    named = {
        "beam_id": F.when(beam == 0, "VB").otherwise(F.concat(F.lit("B"), beam.cast("string"))),
        "beam_type": F.when(beam == 0, "vert").otherwise("slant"),
        "src": F.when(F.col("source") == 2, "VB").otherwise("BT"),
        "freq_khz": F.when(F.isnan(F.col("khz").cast("double")), 0).otherwise(F.coalesce(F.col("khz").cast("int"), F.lit(0))),
    }
    rows = numbered(points.withColumns(named), list(order))
    return rows.select(*(c if c in rows.columns else F.lit(None).cast("string").alias(c) for c in TRACK_COLUMNS))


def surface_table(*parts: DataFrame) -> DataFrame:
    """Water-surface values of all kinds (points, gauges, junctions) as one table of texts; missing values are empty."""
    out = None
    for rows in parts:
        columns = []
        for c in QC_COLUMNS:
            if c not in rows.columns:
                columns.append(F.lit("").alias(c))
            elif c in QC_DECIMALS:
                v = F.col(c).cast("double")
                columns.append(F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), "").otherwise(F.format_string(f"%.{QC_DECIMALS[c]}f", v)).alias(c))
            else:
                columns.append(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c))
        part = rows.select(*columns)
        out = part if out is None else out.unionByName(part)
    return out


def write_recorded(df: DataFrame, path: str, record: str, counters: dict[str, Column], about: dict | None = None, form: str = "parquet") -> dict:
    """Write ``df`` and, from the same pass, a record: one JSON text of ``about``, rows and the ``counters`` (aggregates).

    Counters are gathered by the tasks that write, so nothing is read twice; a task that is
    run again after a loss counts once. Returns the record.
    """
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(name) for name, c in counters.items()))
    observed.write.mode("overwrite").format(form).save(path)
    out = {**(about or {}), "path": path, **seen.get}
    text = json.dumps(out, default=str, sort_keys=True)
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(record)
    return out


def warning_counters(message: str) -> dict[str, Column]:
    """Counters of a log column's rows: warnings, errors and the others."""
    text = F.trim(F.coalesce(F.col(message), F.lit("")))
    error = text.startswith("[error]")
    warn = ~error & (text.startswith("[warn]") | text.startswith("[WARN") | text.contains(" WARN"))
    return {"errors": F.count_if(error), "warnings": F.count_if(warn), "others": F.count_if(~error & ~warn)}
