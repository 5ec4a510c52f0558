"""Vectorised words and hashes over Arrow text columns.

Texts are handled as the UTF-8 buffer of an Arrow column plus row offsets, in
slices of a bounded number of bytes, so no Python string is made for a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes handled at once; temporary arrays take about fifty times as much.
SLICE_BYTES = 500_000
#: Odd multiplier of the rolling word hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

#: Bytes from which on a word is hashed by BLAKE2: a polynomial modulo 2**64 has long words of alternating letters in common.
LONG_WORD = 32

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for i below ``n`` (cached, grown by doubling)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        have = np.multiply.accumulate(out)
        if size <= 8 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its n + 1 row offsets; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    rows = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[rows[0] : rows[-1]], rows - rows[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes; a longer row is a range of its own."""
    n, start = len(offsets) - 1, 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(n, max(end, start + 1))
        yield start, end
        start = end


def cuts(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``limit`` that end at a row's end or after white space."""
    n, start = len(data), 0
    while start < n:
        end = min(n, start + limit)
        if end < n:
            row_end = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
            window = np.flatnonzero(SPACE[data[max(start, end - 4096) : end]])
            space = max(start, end - 4096) + int(window[-1]) + 1 if len(window) else 0
            best = max(row_end, space)
            if best <= start:  # one word as long as the slice
                following = int(offsets[np.searchsorted(offsets, end, side="left")])
                rest = np.flatnonzero(SPACE[data[end:following]])
                best = end + int(rest[0]) + 1 if len(rest) else following
            end = best
        yield start, end
        start = end


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = LOWER, space: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of every row, and the number of words of each row.

    ``fold`` maps bytes before hashing (default: A-Z lower-cased) and ``space``
    marks the separating bytes, taken after folding. Works in byte ranges cut at
    white space, so one very long text needs no more memory than its words.
    """
    n_rows = len(offsets) - 1
    counts = np.zeros(n_rows, np.int64)
    out: list[np.ndarray] = []
    filled = offsets[:-1][np.diff(offsets) > 0]
    for s, e in cuts(data, offsets, SLICE_BYTES):
        part = fold[data[s:e]]
        n = e - s
        gap = space[part]
        first = np.zeros(n + 1, dtype=bool)
        first[0] = first[n] = True
        lo, hi = np.searchsorted(filled, [s, e])
        first[filled[lo:hi] - s] = True
        before = np.empty(n, dtype=bool)
        before[0] = True
        np.logical_or(gap[:-1], first[1:n], out=before[1:])
        starts = np.flatnonzero(before & ~gap)
        after = np.empty(n, dtype=bool)
        after[-1] = True
        np.logical_or(gap[1:], first[1:n], out=after[:-1])
        ends = np.flatnonzero(after & ~gap) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
        back = powers(BASE_INVERSE, n)
        hashes = mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))
        for i in np.flatnonzero(ends - starts >= LONG_WORD).tolist():
            hashes[i] = int.from_bytes(hashlib.blake2b(part[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
        out.append(hashes)
        rows = np.searchsorted(offsets, starts + s, side="right") - 1
        counts += np.bincount(rows, minlength=n_rows)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), counts


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 rows and their row offsets, counted in code points."""
    lead = (data & 0xC0) != 0x80
    lead[offsets[:-1][np.diff(offsets) > 0]] = True  # a row that begins with a torn character stays its own
    at = np.flatnonzero(lead)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    one = padded[at]
    two, three, four = (padded[at + k] & 0x3F for k in (1, 2, 3))
    points = np.where(one < 0xE0, (one & 0x1F) << 6 | two, (one & 0x0F) << 12 | two << 6 | three)
    points = np.where(one < 0xF0, points, (one & 0x07) << 18 | two << 12 | three << 6 | four)
    return np.where(one < 0x80, one, points), np.concatenate([[0], np.cumsum(lead)])[offsets]


def shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words in every row, repeats included, and their counts.

    A row with fewer words has its whole sequence as one run; a row without words has none.
    """
    ends = np.cumsum(counts)
    begins = ends - counts
    n = len(words)
    runs = np.maximum(counts - width + 1, 0)
    acc = np.zeros(max(n - width + 1, 0), np.uint64)
    for j in range(width):
        acc = acc * np.uint64(BASE) + words[j : j + len(acc)] if len(acc) else acc
    acc = mix(acc)
    short = (counts > 0) & (counts < width)
    total = runs + short
    out = np.zeros(int(total.sum()), np.uint64)
    at = np.cumsum(total) - total
    if runs.any():
        place = np.repeat(at - (np.cumsum(runs) - runs), runs) + np.arange(int(runs.sum()))
        source = np.repeat(begins - (np.cumsum(runs) - runs), runs) + np.arange(int(runs.sum()))
        out[place] = acc[source]
    for r in np.flatnonzero(short):
        h = 0
        for w in words[begins[r] : ends[r]].tolist():
            h = (h * BASE + w) & 0xFFFFFFFFFFFFFFFF
        out[at[r]] = mix(np.array([h + int(counts[r])], np.uint64))[0]
    return out, total


def runs(keep: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of marked bytes; none goes over one of ``edges``."""
    n = len(keep)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.ones(n + 1, dtype=bool)
    cut[1:n] = ~keep[1:] | ~keep[:-1]
    cut[edges] = True
    return np.flatnonzero(keep & cut[:-1]), np.flatnonzero(keep & cut[1:]) + 1


def run_hashes(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs; for filters that an exact count follows, as unequal runs may share one."""
    total = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(part)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(BASE_INVERSE, len(part) + 1)[starts] + (ends - starts).astype(np.uint64))


def gathered(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The strings in the byte ranges of ``part``, which may overlap."""
    length = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    place = np.repeat(starts - offsets[:-1], length) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(part[place])))


def by_key(batch: pa.RecordBatch, keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of a batch for each value of its key columns."""
    kinds = pa.Table.from_batches([batch.select(list(keys))]).append_column("row", pa.array(np.arange(batch.num_rows)))
    for found in kinds.group_by(list(keys)).aggregate([("row", "list")]).to_pylist():
        yield tuple(found[k] for k in keys), batch.take(pa.array(found["row_list"]))
