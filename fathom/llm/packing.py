"""Packing documents into windows by Karmarkar-Karp multiway differencing.

Each task tokenises its rows and packs them as they come, in groups of a bounded
number of tokens, so nothing is shuffled and no group grows with the data. Whole
windows of a long document stand alone. What remains of each document is cut into
a few parts, and differencing deals a group's parts into windows of near-equal
length: the two partial partitions with the widest imbalances are merged, the
fullest windows of one with the emptiest of the other, until one is left. If its
fullest window exceeds the capacity, the number of windows rises by one.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fathom.llm.bpe import encode_column, worker_encoder


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal items of the given sizes into ``windows`` of near-equal total."""
    if not sizes:
        return []
    heap = [(-size, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    # a partial partition is its windows' loads, in order and less the least of them
    loads: list[np.ndarray | None] = []
    for size in sizes:
        loads.append(np.zeros(windows, np.int64))
        loads[-1][-1] = size
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = loads[a] + loads[b][::-1]
        order = np.argsort(both, kind="stable")
        both = both[order] - both[order[0]]
        loads[a] = loads[b] = None
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(both[-1]), len(loads)))
        loads.append(both)
    # from the last merge back: which window of each part became which of the whole
    place: list[np.ndarray | None] = [None] * len(loads)
    place[-1] = np.arange(windows)
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        place[a] = order[place[len(sizes) + k]]
        place[b] = windows - 1 - place[a]
        place[len(sizes) + k] = None
    out: list[list[int]] = [[] for _ in range(windows)]
    for i in range(len(sizes)):
        out[int(np.argmax(place[i]))].append(i)
    return out


def fill_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``, as few as differencing finds from the least possible on."""
    if max(sizes, default=0) > capacity:
        raise ValueError("an item is larger than a window")
    windows = -(-sum(sizes) // capacity)
    while True:
        dealt = difference(sizes, windows)
        if all(sum(sizes[i] for i in w) <= capacity for w in dealt):
            return [w for w in dealt if w]
        windows += 1


class ByLibrary:
    """Resolves pre-tokens with the tokenizers library; its added tokens' strings are one id each, as in the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError("only added tokens that stand for their own string are supported")
        self.special = {t.content.encode(): i for i, t in added.items()}

        self.lengths = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.lengths[i] = len(token)  # the vocabulary writes a byte as one character
        (self.line,) = self._alone(["\n"])[0]

    def _alone(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def __call__(self, keys: np.ndarray, pieces: list[bytes]) -> list[list[int]]:
        """Words are put on lines of one text, of which a line's end is a pre-token; white space is encoded by itself."""
        texts = [p.decode() for p in pieces]
        out: list[list[int]] = [[]] * len(pieces)
        words = [i for i, t in enumerate(texts) if not t.isspace()]
        alone = [i for i, t in enumerate(texts) if t.isspace()]
        groups = [words[i : i + 2000] for i in range(0, len(words), 2000)]
        for group, ids in zip(groups, self._alone(["\n".join(texts[i] for i in g) for g in groups])):
            ids = np.array(ids, np.int64)
            ends = np.cumsum([len(pieces[i]) + 1 for i in group])
            reached = np.append(np.cumsum(self.lengths[ids]), ends[-1])
            stop = np.searchsorted(reached, ends)
            start = np.append(0, stop[:-1] + 1)
            lines = stop[:-1] - 1
            if (reached[stop] != ends).any() or (ids[stop[:-1]] != self.line).any() or (reached[lines] != ends[:-1] - 1).any():
                alone += group  # a pre-token crosses a line
                continue
            ids = ids.tolist()
            for i, b, e in zip(group, start.tolist(), stop.tolist()):
                out[i] = ids[b:e]
        for i, ids in zip(alone, self._alone([texts[i] for i in alone])):
            out[i] = ids
        return out


SCHEMA = "doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 1024,
    end_id: int = 0,
    part: int = 256,
    group_windows: int = 128,
) -> DataFrame:
    """Pack all ``docs`` (``doc_id``, ``text``) into sequences of at most ``capacity`` ids.

    ``path`` is the tokenizer's file. A document is its ids and ``end_id``. Returns
    a row per piece: doc_id, start, length, ids (unsigned little-endian 32-bit),
    doc_tokens, sequence_id, offset. Null texts are empty: one piece with the end
    id. Repeated rows and null doc_ids are packed like any other row. An empty
    table gives no pieces.
    """
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder("library", path, lambda: ByLibrary(path))
        sequence = TaskContext.get().partitionId() << 36
        pool: list[tuple] = []  # doc_id, start, ids, doc_tokens
        pooled = 0

        def rows(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [[]] * 7
            kinds = [id_kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def deal() -> pa.RecordBatch:
            nonlocal sequence, pool, pooled
            out = []
            for window in fill_windows([len(p[2]) for p in pool], capacity):
                offset = 0
                for i in window:
                    doc_id, start, ids, total = pool[i]
                    out.append((doc_id, start, len(ids), ids.tobytes(), total, sequence, offset))
                    offset += len(ids)
                sequence += 1
            pool, pooled = [], 0
            return rows(out)

        id_kind = pa.int64()
        for batch in batches:
            id_kind = batch.column(0).type
            doc_ids = batch.column(0).to_pylist()
            for s, e, ids, counts in encode_column(encoder, batch.column(1)):
                ids = ids.astype("<u4")
                at, out = 0, []
                for doc_id, n in zip(doc_ids[s:e], counts.tolist()):
                    own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                    at += n
                    total = n + 1
                    whole = total - total % capacity
                    for start in range(0, whole, capacity):
                        out.append((doc_id, start, capacity, own[start : start + capacity].tobytes(), total, sequence, 0))
                        sequence += 1
                    rest = total - whole
                    parts = -(-rest // part)
                    for k in range(parts):
                        b, f = whole + rest * k // parts, whole + rest * (k + 1) // parts
                        pool.append((doc_id, b, own[b:f], total))
                    pooled += rest
                    if pooled >= group_windows * capacity:
                        yield deal()
                if out:
                    yield rows(out)
        if pool:
            yield deal()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA.format(kind=kind))
