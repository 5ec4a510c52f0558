"""Byte-level BPE encoding and decoding in two tiers.

Pre-tokens are found on the UTF-8 bytes with array operations, each as a span and
a 64-bit hash. A minimal perfect hash over the vocabulary answers pre-tokens that
are whole tokens. The rest are merged by rank with a heap over a linked list of
their bytes. A worker keeps what it has resolved in a bounded store, from one task to
the next, so a frequent word is looked up once. The store is a cache only: what it
gives for a hash is compared with the pre-token's bytes, so results don't depend on it.
Texts are read in slices of a bounded number of bytes, long ones cut between pre-tokens.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fathom.llm._text import BASE, BASE_INVERSE, SLICE_BYTES, mix, powers, row_slices, utf8_buffers

#: Slots of a worker's store, and bytes of pre-tokens in it before it starts over.
MEMO_SLOTS, MEMO_BYTES = 1 << 19, 6_000_000
#: Bytes that are searched at once for a place to cut a long text.
CUT_BYTES = 65_536
LETTER, NUMBER, BLANK, OTHER = 0, 1, 2, 3

_classes: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """Letter, number, white space or other for every code point."""
    global _classes
    if _classes is None:
        import regex

        every = "".join(map(chr, [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]))
        out = np.full(0x110000, OTHER, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\p{White_Space}")):
            out[[ord(c) for c in regex.findall(pattern, every)]] = kind
        _classes = out
    return _classes


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of valid UTF-8 and the byte position of each."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead].astype(np.int32)
    out = first.copy()
    wide = np.flatnonzero(first >= 0xC0)
    if len(wide):
        at, b = lead[wide], first[wide]
        more = lambda k: data[np.minimum(at + k, len(data) - 1)].astype(np.int32) & 0x3F
        two = (b & 0x1F) << 6 | more(1)
        three = (b & 0x0F) << 12 | more(1) << 6 | more(2)
        four = (b & 0x07) << 18 | more(1) << 12 | more(2) << 6 | more(3)
        out[wide] = np.where(b < 0xE0, two, np.where(b < 0xF0, three, four))
    return out, lead


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all pre-tokens, in order, and the number of them in each row.

    The rule: a contraction (``'s 't 're 've 'm 'll 'd``); else a run of letters,
    numbers or other marks with at most one space before it; else white space, of
    which the last character before a word stands apart.
    """
    n_rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(n_rows, np.int64)
    points, lead = code_points(data)
    kind = char_classes()[points]
    n = len(points)
    new = np.zeros(n + 1, bool)  # a row starts here
    new[np.searchsorted(lead, offsets)] = True
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge |= new[:n]
    runs = np.flatnonzero(edge)
    ends = np.append(runs[1:], n)
    what = kind[runs]
    start = edge.copy()
    # the last blank before a word is a token of its own, or joins the word if it is a space
    blank = np.flatnonzero(what == BLANK)
    blank = blank[~new[ends[blank]]]
    last = ends[blank] - 1
    start[last] = True
    joins = points[last] == 0x20
    joined = blank[joins] + 1
    start[ends[blank[joins]]] = False
    # contractions
    free = np.ones(len(runs), bool)
    free[joined] = False
    quote = np.flatnonzero((what == OTHER) & free & (ends - runs == 1) & (points[runs] == 0x27))
    quote = quote[~new[ends[quote]]]
    if len(quote):
        after = ends[quote]
        quote, after = quote[kind[after] == LETTER], after[kind[after] == LETTER]
        a = points[after]
        b = np.where((after + 1 < n) & ~new[np.minimum(after + 1, n)], points[np.minimum(after + 1, n - 1)], 0)
        one = np.isin(a, [0x73, 0x74, 0x6D, 0x64])
        two = ((a == 0x72) | (a == 0x76)) & (b == 0x65) | (a == 0x6C) & (b == 0x6C)
        start[after[one | two]] = False
        cut_at = np.concatenate([after[one] + 1, after[two & ~one] + 2])
        cut_at = cut_at[cut_at < n]
        start[cut_at] = True
    tokens = lead[np.flatnonzero(start)]
    return tokens, np.diff(np.searchsorted(tokens, offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(BASE_INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


class PerfectHash:
    """A minimal perfect hash of 64-bit keys: buckets of keys, each moved by its own displacement."""

    STEP = np.uint64(0xD1B54A32D192ED03)

    def __init__(self, keys: np.ndarray):
        self.n = n = len(keys)
        self.buckets = max(1, n // 4)
        self.shift = np.zeros(self.buckets, np.int64)
        self.value = np.zeros(n, np.int64)
        self.key = np.zeros(n, np.uint64)
        if len(np.unique(keys)) < n:
            raise ValueError("two tokens have one hash")
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        begin = np.cumsum(sizes) - sizes
        free = np.ones(n, bool)
        for size in range(int(sizes.max(initial=0)), 1, -1):
            left, d = np.flatnonzero(sizes == size), 0
            own = order[begin[left][:, None] + np.arange(size)]
            while len(left) > 64:  # all buckets of a size are tried with one displacement at once
                places = self._moved(keys[own], np.array([d], np.uint64))
                fits = free[places].all(axis=1) & self._differ(places)
                claim = np.full(n, len(left))
                np.minimum.at(claim, places[fits], np.flatnonzero(fits)[:, None])
                fits &= (claim[places] == np.arange(len(left))[:, None]).all(axis=1)
                slots, members = places[fits], own[fits]
                free[slots] = False
                self.value[slots], self.key[slots], self.shift[left[fits]] = members, keys[members], d
                left, own, d = left[~fits], own[~fits], d + 1
            for b, members in zip(left.tolist(), own):  # the last ones with many displacements each
                at = d
                while True:
                    places = self._moved(keys[members], np.arange(at, at + 512, dtype=np.uint64)[:, None])
                    fits = np.flatnonzero(free[places].all(axis=1) & self._differ(places))
                    if len(fits):
                        break
                    at += 512
                slots = places[fits[0]]
                free[slots] = False
                self.value[slots], self.key[slots], self.shift[b] = members, keys[members], at + fits[0]
        one = np.flatnonzero(sizes == 1)  # what is left takes the free slots in turn
        slots, members = np.flatnonzero(free), order[begin[one]]
        self.value[slots], self.key[slots], self.shift[one] = members, keys[members], -1 - slots

    def _moved(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(keys + shift * self.STEP) % np.uint64(self.n)).astype(np.int64)

    @staticmethod
    def _differ(places: np.ndarray) -> np.ndarray:
        ordered = np.sort(places, axis=1)
        return (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys >> np.uint64(33)) % np.uint64(self.buckets)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key among those it was built from, or -1."""
        shift = self.shift[self._bucket(keys)]
        moved = self._moved(keys, shift.astype(np.uint64))
        slot = np.where(shift < 0, -1 - shift, moved)
        return np.where(self.key[slot] == keys, self.value[slot], -1)


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the bytes of ``piece`` by lowest rank, leftmost first."""
    n = len(piece)
    after = list(range(1, n + 1))  # where the part that starts here ends
    before = list(range(-1, n - 1))
    live = [True] * n
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not live[i]:
            continue
        middle = after[i]
        if middle >= n or after[middle] != end:
            continue
        live[middle] = False
        after[i] = end
        if end < n:
            before[end] = i
            rank = ranks.get(piece[i : after[end]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, after[end]))
        left = before[i]
        if left >= 0:
            rank = ranks.get(piece[left:end])
            if rank is not None:
                heapq.heappush(heap, (rank, left, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class TwoTier:
    """Resolves pre-tokens: whole tokens by the perfect hash, others by merging."""

    special: dict[bytes, int] = {}

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        joined = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum([len(t) for t in tokens])
        starts = ends - [len(t) for t in tokens]
        self.index = PerfectHash(span_hashes(joined, starts, ends))
        self.ranks: dict[bytes, int] | None = None

    def __getstate__(self):
        return self.__dict__ | {"ranks": None}

    def __call__(self, keys: np.ndarray, pieces: list[bytes]) -> list[list[int]]:
        if self.ranks is None:
            self.ranks = {t: i for i, t in enumerate(self.tokens)}
        return [
            [k] if k >= 0 and self.tokens[k] == piece else merge_bytes(piece, self.ranks)
            for k, piece in zip(self.index.find(keys).tolist(), pieces)
        ]


class _Growing:
    """An array that values are appended to."""

    def __init__(self, kind: type):
        self.values, self.n = np.zeros(1024, kind), 0

    def append(self, more: np.ndarray) -> int:
        """Where ``more`` starts."""
        at, self.n = self.n, self.n + len(more)
        if self.n > len(self.values):
            self.values = np.concatenate([self.values[:at], np.zeros(2 * self.n - at, self.values.dtype)])
        self.values[at : self.n] = more
        return at


class Encoder:
    """Encodes slices of a text column and keeps what it has resolved, a pre-token to a slot."""

    def __init__(self, resolve: Callable[[np.ndarray, list[bytes]], list[list[int]]], slots: int = MEMO_SLOTS, limit: int = MEMO_BYTES):
        self.resolve, self.limit = resolve, limit
        self.mask = np.uint64(slots - 1)
        self.keys = np.zeros(slots, np.uint64)
        self.entry = np.zeros(slots, np.int32)
        self._clear()

    def _clear(self) -> None:
        self.keys[:] = 0
        self.ids, self.bytes = _Growing(np.int32), _Growing(np.uint8)
        #: Of every entry: where its ids and its bytes start, and how many they are.
        self.at, self.size, self.where, self.length = (_Growing(np.int32) for _ in range(4))

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """The entries of new pre-tokens."""
        found = self.resolve(keys, pieces)
        size, length = np.array([len(x) for x in found], np.int64), np.array([len(x) for x in pieces], np.int64)
        at = self.ids.append(np.array([i for x in found for i in x], np.int32))
        where = self.bytes.append(np.frombuffer(b"".join(pieces), np.uint8))
        first = self.at.append(at + np.cumsum(size) - size)
        self.size.append(size)
        self.where.append(where + np.cumsum(length) - length)
        self.length.append(length)
        return first + np.arange(len(pieces))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows, one after another, and their number in each row."""
        starts, per_row = pre_tokens(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        if self.bytes.n > self.limit:
            self._clear()
        ends = np.append(starts[1:], len(data))
        lengths = ends - starts
        keys = span_hashes(data, starts, ends)
        slot = (keys & self.mask).astype(np.int64)
        entry = self.entry[slot].astype(np.int64)
        new = np.flatnonzero(self.keys[slot] != keys)
        pieces = lambda which: [data[s:e].tobytes() for s, e in zip(starts[which].tolist(), ends[which].tolist())]
        if len(new):
            fresh, first, inverse = np.unique(keys[new], return_index=True, return_inverse=True)
            learnt = self._learn(fresh, pieces(new[first]))
            entry[new] = learnt[inverse]
            self.keys[slot[new[first]]], self.entry[slot[new[first]]] = fresh, learnt
        # an entry of the same hash is another pre-token's unless the bytes agree
        other = self.length.values[entry] != lengths
        place = np.repeat(np.where(other, 0, self.where.values[entry]) - starts, lengths) + np.arange(len(data))
        wrong = self.bytes.values[np.minimum(place, self.bytes.n - 1)] != data
        if wrong.any() or other.any():
            other[np.searchsorted(starts, np.flatnonzero(wrong), side="right") - 1] = True
            own, at = np.flatnonzero(other), {}
            for piece in (names := pieces(own)):
                at.setdefault(piece, len(at))
            hashes = np.array([keys[own[names.index(p)]] for p in at], np.uint64)
            entry[own] = self._learn(hashes, list(at))[[at[p] for p in names]]
        size = self.size.values[entry].astype(np.int64)
        total = np.cumsum(size)
        begin = np.repeat(self.at.values[entry] - (total - size), size)
        ids = self.ids.values[begin + np.arange(len(begin))]
        bounds = np.concatenate([[0], total])[np.concatenate([[0], np.cumsum(per_row)])]
        return ids, np.diff(bounds)


def cut_places(data: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of one text of about ``limit``, cut between pre-tokens: after a word, before white space or a mark.

    A range is longer only where the text has no such place.
    """
    start, n = 0, len(data)
    while n - start > limit:
        at, end = start + limit, 0
        while not end and at < n:
            window = data[max(start, at - CUT_BYTES) : at + 4]
            points, lead = code_points(window[np.argmax((window & 0xC0) != 0x80) :])
            lead = lead + max(start, at - CUT_BYTES) + int(np.argmax((window & 0xC0) != 0x80))
            kind = char_classes()[points[:-4]]  # the last ones may be torn
            word = (kind[:-1] == LETTER) | (kind[:-1] == NUMBER)
            good = np.flatnonzero(word & ((kind[1:] == BLANK) | (kind[1:] == OTHER)))
            good = good[lead[good + 1] > start]
            end = int(lead[good[-1] + 1]) if len(good) else 0
            at += CUT_BYTES - 64
        if not end:
            break
        yield start, end
        start = end
    if start < n or not n:
        yield start, n


def encode_column(encoder: Encoder, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, ids of each row) for all rows of a text column.

    The strings of ``encoder.resolve.special`` are one id each, wherever they stand.
    """
    special = encoder.resolve.special
    names = re.compile(b"|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
    data, offsets = utf8_buffers(column)
    for s, e in row_slices(offsets):
        part, own = data[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s]
        met = [m.span() for m in names.finditer(part.tobytes())] if names else []
        if not met and len(part) <= SLICE_BYTES:
            yield s, e, *encoder.encode(part, own)
            continue
        for row in range(s, e):
            text = part[own[row - s] : own[row - s + 1]]
            pieces, at = [np.zeros(0, np.int32)], 0
            for m in [*(names.finditer(text.tobytes()) if met else ()), None]:
                stop = m.start() if m else len(text)
                for b, f in cut_places(text[at:stop], SLICE_BYTES):
                    pieces.append(encoder.encode(text[at + b : at + f], np.array([0, f - b]))[0])
                if m:
                    pieces.append(np.array([special[m[0]]], np.int32))
                    at = m.end()
            ids = np.concatenate(pieces)
            yield row, row + 1, ids, np.array([len(ids)])


#: What a worker keeps between tasks, by kind and file.
_encoders: dict[tuple[str, str], Encoder] = {}


def worker_encoder(kind: str, path: str, resolver: Callable) -> Encoder:
    """This worker's encoder for the file ``path``, made by ``resolver`` when it is first asked for."""
    if (kind, path) not in _encoders:
        _encoders[kind, path] = Encoder(resolver())
    return _encoders[kind, path]


@functools.lru_cache(maxsize=4)
def two_tier(path: str) -> TwoTier:
    return TwoTier(load_ranks(path))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text with the ranks in the file ``path``.

    Returns ``key`` and ``ids`` (array of int). A null text is an empty one and has
    no ids. Repeated rows are encoded each; other columns are left out; an empty
    table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(two_tier(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder("ranks", path, lambda: model.value)
        for batch in batches:
            for s, e, ids, counts in encode_column(encoder, batch.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s, e - s), lists], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """The bytes of each row's ``ids``: returns ``key``, ``ids`` and ``decoded`` (binary).

    Null ids give null bytes, no ids empty ones; an id outside the vocabulary is an error.
    """
    tokens = encoded.sparkSession.sparkContext.broadcast(two_tier(path).tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = tokens.value
        flat = np.frombuffer(b"".join(names), np.uint8)
        lengths = np.array([len(t) for t in names], np.int64)
        begins = np.cumsum(lengths) - lengths
        for batch in batches:
            column = batch.column(1)
            for s, e in row_slices(4 * np.append(0, np.cumsum(np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)))):
                part = column.slice(s, e - s)
                ids = np.asarray(part.flatten()).astype(np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() >= len(names)):
                    raise ValueError("an id is outside the vocabulary")
                counts = np.asarray(part.value_lengths().fill_null(0)).astype(np.int64)
                size = lengths[ids]
                total = np.cumsum(size)
                out = flat[np.repeat(begins[ids] - (total - size), size) + np.arange(int(size.sum()))]
                bounds = np.append(0, total)[np.append(0, np.cumsum(counts))]
                raw = pa.Array.from_buffers(
                    pa.binary(), e - s, [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())]
                )
                if part.null_count:
                    raw = pa.array([None if gone else x for gone, x in zip(part.is_null().to_pylist(), raw.to_pylist())], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s, e - s), part, raw], names=[key, "ids", "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, ids array<int>, decoded binary")
