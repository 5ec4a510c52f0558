"""MAT version 5 files, one per transect, as rows of ensembles.

``binaryFile`` deals the files out and every task decodes its own; nothing passes the
driver. Only what a survey needs is read: little-endian files, compressed or not, with
numeric, text and structure arrays.
"""

from __future__ import annotations

import io
import itertools
import struct
import zlib
from collections.abc import Collection, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: element types as numpy kinds, and array classes.
KINDS = {1: "i1", 2: "u1", 3: "<i2", 4: "<u2", 5: "<i4", 6: "<u4", 7: "<f4", 9: "<f8", 12: "<i8", 13: "<u8", 16: "u1", 17: "<u2"}
MATRIX, COMPRESSED, STRUCT, TEXT = 14, 15, 2, 4


def _elements(data: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at + 8 <= len(data):
        kind, size = struct.unpack_from("<II", data, at)
        if kind >> 16:  # a short element holds its data in the tag
            yield kind & 0xFFFF, data[at + 4 : at + 4 + (kind >> 16)]
            at += 8
            continue
        yield kind, data[at + 8 : at + 8 + size]
        at += 8 + size + (0 if kind == COMPRESSED else -size % 8)


def _array(data: bytes):
    """(name, value): a numpy array, a text or a dict."""
    if not data:
        return "", np.zeros(0)
    parts = list(_elements(data))
    kind = parts[0][1][0]
    shape = np.frombuffer(parts[1][1], "<i4")
    name = parts[2][1].decode("latin-1")
    if kind == STRUCT:
        width = int(np.frombuffer(parts[3][1], "<i4")[0])
        fields = [parts[4][1][i : i + width].split(b"\0")[0].decode() for i in range(0, len(parts[4][1]), width)]
        return name, {f: _array(body)[1] for f, (_, body) in zip(fields, parts[5:])}
    values = np.frombuffer(parts[3][1], KINDS[parts[3][0]]) if len(parts) > 3 else np.zeros(0)
    if kind == TEXT:
        return name, "".join(map(chr, values))
    return name, values.reshape(shape, order="F")


#: Bytes that hold a variable's flags, shape and name, as the format bounds them.
HEAD = 512


def variables(file: BinaryIO, wanted: Collection[str] | None = None, tally: dict | None = None) -> Iterator[tuple[str, object]]:
    """(name, value) of a file's variables, or of those ``wanted`` only.

    Of the others no more than HEAD bytes are read and inflated, as their names are: the
    reader goes on behind them. ``tally`` counts ``read`` and ``inflated`` bytes and ``kept`` variables.
    """
    tally = {} if tally is None else tally

    def read(n: int) -> bytes:
        got = file.read(n)
        tally["read"] = tally.get("read", 0) + len(got)
        return got

    def inflate(body: bytes, limit: int = 0) -> bytes:
        got = zlib.decompressobj().decompress(body, limit)
        tally["inflated"] = tally.get("inflated", 0) + len(got)
        return got

    if read(128)[126:128] != b"IM":
        raise ValueError("not a little-endian MAT version 5 file")
    at = 128
    while len(tag := read(8)) == 8:
        kind, size = struct.unpack("<II", tag)
        at += 8 + size + (0 if kind == COMPRESSED else -size % 8)
        body = b""
        if wanted is not None and kind in (COMPRESSED, MATRIX):
            body = read(min(size, HEAD))
            head = inflate(body, HEAD)[8:] if kind == COMPRESSED else body
            named = [x for _, x in itertools.islice(_elements(head), 3)]
            if len(named) == 3 and named[2].decode("latin-1") not in wanted:
                file.seek(at)
                continue
        body += read(size - len(body))
        if kind == COMPRESSED:
            kind, body = next(_elements(inflate(body)))
        if kind == MATRIX:
            tally["kept"] = tally.get("kept", 0) + 1
            yield _array(body)
        file.seek(at)


def decode(data: bytes, wanted: Collection[str] | None = None) -> dict:
    """The variables of a file by name."""
    return dict(variables(io.BytesIO(data), wanted))


SCHEMA = """perfil string, ens int, vb_depth double, bt_beams array<double>, khz double, bt_depth double, utm_e double, utm_n double, lat double, lon double,
 heading double, time double, step double, pitch double, roll double, mean_ve double, mean_vn double, total_q double,
 summary_depth double, edge_left double, edge_right double, start_edge double, sensor_depth double, depth_reference double, error string"""


def _column(tree: dict, path: str, n: int, default: float = np.nan) -> np.ndarray:
    group, field = path.split(".")
    value = tree.get(group, {}).get(field) if isinstance(tree.get(group), dict) else None
    flat = np.asarray(value, float).reshape(-1) if value is not None and np.size(value) else np.array([default])
    return flat if len(flat) == n else np.full(n, flat[0])


#: Where a column stands (group and field), its place in the pair for two-column fields, and what a missing field means.
COLUMNS = {
    "vb_depth": ("BottomTrack.VB_Depth", np.nan), "khz": ("BottomTrack.BT_Frequency", 3000.0), "bt_depth": ("BottomTrack.BT_Depth", np.nan),
    "lat": ("GPS.Latitude", np.nan), "lon": ("GPS.Longitude", np.nan), "heading": ("System.True_North_ADP_Heading", np.nan), "time": ("System.Time", np.nan),
    "step": ("System.Step", 3.0), "pitch": ("Compass.Pitch", 0.0), "roll": ("Compass.Roll", 0.0), "total_q": ("Summary.Total_Q", np.nan),
    "summary_depth": ("Summary.Depth", np.nan), "edge_left": ("Setup.Edges_0__DistanceToBank", 0.0), "edge_right": ("Setup.Edges_1__DistanceToBank", 0.0),
    "start_edge": ("Setup.startEdge", 1.0), "sensor_depth": ("Setup.sensorDepth", 0.0), "depth_reference": ("Setup.depthReference", 0.0),
}
PAIRS = {"utm_e": ("GPS", "UTM", 0), "utm_n": ("GPS", "UTM", 1), "mean_ve": ("Summary", "Mean_Vel", 0), "mean_vn": ("Summary", "Mean_Vel", 1)}
KINDS_OF = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "array<double>": pa.list_(pa.float64())}


def group_of(column: str) -> str | None:
    """The variable that a column of SCHEMA is read from; None: from none."""
    if column == "bt_beams":
        return "BottomTrack"
    return PAIRS[column][0] if column in PAIRS else COLUMNS[column][0].split(".")[0] if column in COLUMNS else None


def schema_of(groups: Collection[str] | None = None) -> list[tuple[str, str]]:
    """(column, type) of SCHEMA, or of what the given variables hold."""
    pairs = [tuple(f.split()) for f in SCHEMA.replace("\n", " ").split(",")]
    return [(c, k) for c, k in pairs if groups is None or group_of(c) is None or group_of(c) in groups]


def _rows(stem: str, file: BinaryIO, columns: list[tuple[str, str]], tally: dict | None = None) -> pa.RecordBatch:
    """The ensembles of a file; one row with the error if it can't be decoded."""
    groups = {g for c, _ in columns if (g := group_of(c))}
    try:
        tree = dict(variables(file, groups, tally))
        pair = {c: np.asarray(tree[g][f], float).reshape(-1, 2)[:, k] for c, (g, f, k) in PAIRS.items() if g in groups and f in tree.get(g, {})}
        if "BottomTrack" in groups:
            beams = np.asarray(tree["BottomTrack"]["BT_Beam_Depth"], float).reshape(-1, 4)
            n = len(beams)
        else:  # without the beams: as many as the longest field
            beams = None
            n = max([len(v) for v in pair.values()] + [np.size(tree[g][f]) for g, f in (p.split(".") for p, _ in COLUMNS.values()) if g in tree and f in tree[g]])
        out = {c: v if len(v) == n else np.full(n, np.nan) for c, v in pair.items()}
        out |= {c: _column(tree, p, n, d) for c, (p, d) in COLUMNS.items() if p.split(".")[0] in groups}
        if "System" in groups:  # the instrument's own heading and the ensemble's number stand in for what is not recorded
            system = tree.get("System", {})
            if np.size(system.get("True_North_ADP_Heading", ())) == 0:
                out["heading"] = _column(tree, "System.Heading", n)
            if np.size(system.get("Time", ())) == 0:
                out["time"] = np.arange(n, dtype=float)
        out |= {"perfil": [stem] * n, "ens": list(range(n))} | ({"bt_beams": beams.tolist()} if beams is not None else {})
    except Exception as problem:  # a bad file is a row that says so
        n, out = 1, {"perfil": [stem], "error": [str(problem)[:200]]}
    arrays = [pa.array(out[c], KINDS_OF[k], from_pandas=True) if c in out else pa.nulls(n, KINDS_OF[k]) for c, k in columns]
    return pa.RecordBatch.from_arrays(arrays, names=[c for c, _ in columns])


def read_transects(spark: SparkSession, paths: str | list[str], groups: Collection[str] | None = None) -> DataFrame:
    """A row per ensemble of every file; a file that can't be decoded gives one row with the error. NaN becomes null.

    ``groups`` names the variables to inflate; columns of others are left out. A file that
    several of ``paths`` lead to is read once: paths are compared before any content is read.
    """
    given = spark.read.format("binaryFile").option("pathGlobFilter", "*.mat")
    files = given.load(paths)
    if not isinstance(paths, str) and len(paths) > 1:
        listed = [r.path for r in files.select("path").distinct().orderBy("path").collect()]
        files = given.load(listed) if listed else files
    columns = schema_of(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield _rows(path.rsplit("/", 1)[-1].rsplit(".", 1)[0], io.BytesIO(content), columns)

    return files.select("path", "content").mapInArrow(run, ", ".join(f"{c} {k}" for c, k in columns))


def transect_setup(ensembles: DataFrame) -> DataFrame:
    """A row per transect: distances from the edges to the banks (left, right), side of the start, draft and depth reference.

    Files without a setup have edges and a draft of 0, start on the right and take the vertical
    beam. The recorded depths hold the draft already; it is not to be added again.
    """
    held = lambda c: F.max(F.col(c))
    side = F.when(held("start_edge") == 0, "left").otherwise("right")
    reference = F.when(F.coalesce(held("depth_reference"), F.lit(0.0)) < 0.5, "vb").otherwise("bt")
    return ensembles.filter("error is null").groupBy("perfil").agg(
        F.coalesce(held("edge_left"), F.lit(0.0)).alias("left"), F.coalesce(held("edge_right"), F.lit(0.0)).alias("right"), side.alias("start"),
        F.coalesce(held("sensor_depth"), F.lit(0.0)).alias("draft"), reference.alias("depth_reference"), F.count("*").alias("ensembles"),
    )
