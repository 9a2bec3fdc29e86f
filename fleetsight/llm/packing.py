"""Pack documents into fixed-size training sequences by multiway differencing.

Each task streams its documents, cuts them into pieces and fills groups of windows. In a group the
Karmarkar-Karp method merges the two partial partitions with the largest imbalance, the full
windows of one with the empty ones of the other, until one partition is left: its windows are
nearly equal. If one of them exceeds the capacity, the group is partitioned again with one window
more. Nothing is shuffled, and a task holds one group at a time.

Defined cases: null text counts as empty and gives the end id alone; a null id is kept; repeated
rows are packed once for each row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetsight.llm import tokens
from fleetsight.llm.common import PART_BYTES, slices

WINDOW = 2048
GROUP_WINDOWS = 128
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary())]
)


def difference(lengths: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Partition ``lengths`` into ``k`` windows: (window of each item, window sums).

    A partial partition is a row of ``k`` windows in descending order of their sums; each window
    is a chain of items, held by its first and last one.
    """
    n = len(lengths)
    after = np.full(n, -1, np.int64)
    heap = []
    for i, size in enumerate(lengths):
        sums, first, last = np.zeros(k, np.int64), np.full(k, -1, np.int64), np.full(k, -1, np.int64)
        sums[0], first[0], last[0] = size, i, i
        heap.append((-(size if k > 1 else 0), i, sums, first, last))
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, _, sums, first, last = heapq.heappop(heap)
        _, _, other, first2, last2 = heapq.heappop(heap)
        sums, first2, last2 = sums + other[::-1], first2[::-1], last2[::-1]
        both = (first >= 0) & (first2 >= 0)
        after[last[both]] = first2[both]
        first = np.where(first >= 0, first, first2)
        last = np.where(last2 >= 0, last2, last)
        order = np.argsort(-sums, kind="stable")
        sums, first, last = sums[order], first[order], last[order]
        heapq.heappush(heap, (int(sums[-1] - sums[0]), made, sums, first, last))
        made += 1
    window = np.empty(n, np.int64)
    if not heap:
        return window, np.zeros(k, np.int64)
    _, _, sums, first, _ = heap[0]
    for w, item in enumerate(first.tolist()):
        while item >= 0:
            window[item] = w
            item = int(after[item])
    return window, sums


def windows(lengths: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """The window of each item, with the least count tried that keeps all windows within capacity."""
    k = max(1, -(-sum(lengths) // capacity))
    while True:
        window, sums = difference(lengths, k)
        if sums.max(initial=0) <= capacity:
            return window, k
        k += 1


class _Packer:
    """Groups of pieces of one task; ``put`` and ``close`` give finished rows."""

    def __init__(self, base: int, capacity: int, group_windows: int, piece: int, slack: int):
        self.next_sequence, self.capacity, self.piece = base, capacity, piece
        self.room = group_windows * (capacity - slack)
        self.held: list[tuple] = []
        self.size = 0

    def _row(self, doc, start, ids, total, sequence, offset):
        return (doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset, ids)

    def put(self, doc: int | None, ids: bytes) -> Iterator[tuple]:
        total, start, at = len(ids) // 4, 0, memoryview(ids)
        while total - start >= self.capacity:  # a whole sequence by itself
            yield self._row(doc, start, bytes(at[4 * start : 4 * (start + self.capacity)]), total, self.next_sequence, 0)
            self.next_sequence += 1
            start += self.capacity
        while start < total:
            length = min(self.piece, total - start, self.room - self.size)
            self.held.append((doc, start, bytes(at[4 * start : 4 * (start + length)]), total))
            self.size += length
            start += length
            if self.size == self.room:
                yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.held:
            window, k = windows([len(p[2]) // 4 for p in self.held], self.capacity)
            filled = [0] * k
            for (doc, start, ids, total), w in zip(self.held, window.tolist(), strict=True):
                yield self._row(doc, start, ids, total, self.next_sequence + w, filled[w])
                filled[w] += len(ids) // 4
            self.next_sequence += k
        self.held, self.size = [], 0


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 1,
    capacity: int = WINDOW,
    group_windows: int = GROUP_WINDOWS,
    piece: int = 512,
    slack: int = 8,
    with_ids: bool = True,
) -> DataFrame:
    """One row for each piece of a document in a sequence of at most ``capacity`` ids.

    ``piece`` is the longest cut that goes into a shared window; smaller pieces balance better.
    ``slack`` ids of each window stay free when a group is closed. ``ids`` holds the piece's ids
    as little-endian unsigned 32-bit integers (null without ``with_ids``).
    """
    path = tokenizer or tokens.default_tokenizer()
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path)
        packer = _Packer(TaskContext.get().partitionId() << 40, capacity, group_windows, piece, slack)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * len(_ARROW)
            if not with_ids:
                columns[-1] = [None] * len(rows)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW.types, strict=True)], schema=_ARROW)

        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                rows = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                    rows.extend(packer.put(doc, ids + end))
                if rows:
                    yield out(rows)
        if rows := list(packer.close()):
            yield out(rows)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, SCHEMA)
