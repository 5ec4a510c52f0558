"""Vectors of embeddings as bytes: what the searches over them share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def float_kind(df: DataFrame, column: str = "embedding") -> str:
    return "<f4" if "float" in df.schema[column].dataType.simpleString() else "<f8"


def packed(vectors: DataFrame, zero_too: bool) -> DataFrame:
    """(vec_id, vector) of every row: vector holds the components, little-endian, as they are.

    It is null where the embedding is null, empty, holds null or non-finite components
    or, unless ``zero_too``, only zeros.
    """
    kind = float_kind(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
            flat = column.flatten()
            values = np.asarray(flat.fill_null(float("nan"))).astype(kind)
            ends = np.cumsum(lengths)
            wrong = np.append(0, np.cumsum(~np.isfinite(values)))
            some = np.append(0, np.cumsum(values != 0))
            good = (lengths > 0) & (wrong[ends] == wrong[ends - lengths])
            if not zero_too:
                good &= some[ends] > some[ends - lengths]
            raw, size = values.tobytes(), np.dtype(kind).itemsize
            out = [
                raw[(e - n) * size : e * size] if ok else None
                for ok, e, n in zip(good.tolist(), ends.tolist(), lengths.tolist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["vec_id", "vector"])

    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return chosen.mapInArrow(run, "vec_id long, vector binary")


def matrix(column: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length as the rows of a matrix of doubles."""
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype(np.float64)
