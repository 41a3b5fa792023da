"""Operator 6: packing token sequences by Karmarkar-Karp multiway differencing.

Each input partition streams through one Arrow function: texts become ids, a
document's full windows leave at once, and what remains of documents gathers in
a pool. When the pool holds ``group`` windows' worth of tokens it is packed:
every item starts as a partial partition of k windows with one window filled;
the two partial partitions with the largest imbalances merge, largest windows
against smallest, until one partition is left. Its windows are nearly equal, so
with k x capacity barely above the total all of them are nearly full. If one
exceeds the capacity, k rises by one and the group is packed anew. A share of
the group is cut into small pieces first: they are what differencing levels the
windows with.

Memory holds one group and one Arrow batch, no row is shuffled, and partitions are
independent. The last tokens of a partition, less than a window, are laid out
in sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import byte_batches, lean, ship, text_of
from marketlens.llm.token_counts import encoder, tokenizer_path

CAPACITY = 4096
END_ID = 2
#: Windows of a group, tokens left free in each on average, and (share of the group, piece length) of the small pieces.
GROUP, FREE, FINE = 64, 6, ((0.1, 96), (0.02, 12))

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long")


def karmarkar_karp(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window (0 .. k-1) of each item by largest multiway differencing; stable for ties."""
    n = len(sizes)
    if k == 1:
        return np.zeros(n, np.int64)
    left, right = [], []  # inner nodes of the item trees: node n + i has these two children
    heap = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        sums, node = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], node[0] = sizes[i], i
        heap.append((-int(sizes[i]), len(heap), sums, node))
    heapq.heapify(heap)
    at = len(heap)
    while len(heap) > 1:
        _, _, s1, n1 = heapq.heappop(heap)
        _, _, s2, n2 = heapq.heappop(heap)
        s, n2 = s1 + s2[::-1], n2[::-1]
        both = (n1 >= 0) & (n2 >= 0)
        node = np.maximum(n1, n2)
        if both.any():
            node[both] = n + len(left) + np.arange(int(both.sum()))
            left += n1[both].tolist()
            right += n2[both].tolist()
        order = np.argsort(-s, kind="stable")
        s = s[order]
        s -= s[-1]
        heapq.heappush(heap, (-int(s[0]), at, s, node[order]))
        at += 1
    out = np.zeros(n, np.int64)
    for w, top in enumerate(heap[0][3].tolist() if heap else []):
        stack = [top] if top >= 0 else []
        while stack:
            x = stack.pop()
            if x < n:
                out[x] = w
            else:
                stack += (left[x - n], right[x - n])
    return out


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """(window of each item, number of windows): as few near-equal windows as differencing fits under the capacity."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        at = karmarkar_karp(sizes, k)
        if np.bincount(at, sizes, k).max(initial=0) <= capacity:
            return at, k
        k += 1


class _Packer:
    """Gathers pieces of one partition and yields their placement."""

    def __init__(self, capacity: int, group: int, partition: int):
        self.capacity, self.group = capacity, group
        self.next = partition << 33  # 2^33 sequences for each partition
        self.pool: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.total = 0
        self.rows: list[tuple] = []

    def _place(self, piece: tuple, sequence: int, offset: int) -> None:
        doc, start, ids, n = piece
        self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), n, sequence, offset))

    @staticmethod
    def _cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
        doc, start, ids, n = piece
        return (doc, start, ids[:at], n), (doc, start + at, ids[at:], n)

    def add(self, doc, ids: np.ndarray) -> None:
        n, c = len(ids), self.capacity
        full = n // c * c
        for start in range(0, full, c):
            self._place((doc, start, ids[start:start + c], n), self.next, 0)
            self.next += 1
        if full < n:
            self.pool.append((doc, full, ids[full:].copy() if full else ids, n))
            self.total += n - full
            if self.total >= self.group * c:
                self._flush(self.group)

    def _take(self, tokens: int) -> list[tuple]:
        """The first ``tokens`` tokens of the pool, the last document cut where needed."""
        got, have = [], 0
        for i, piece in enumerate(self.pool):
            if have + len(piece[2]) > tokens:
                head, tail = self._cut(piece, tokens - have)
                if len(head[2]):
                    got.append(head)
                self.pool = [tail, *self.pool[i + 1:]]
                break
            got.append(piece)
            have += len(piece[2])
        else:
            self.pool = []
        self.total = sum(len(p[2]) for p in self.pool)
        return got

    def _flush(self, k: int) -> None:
        target = k * (self.capacity - FREE)
        fine = []  # the last tokens of the group, cut small
        items = self._take(target)
        for share, length in FINE:
            left = int(share * target)
            while left > 0 and items:
                piece = items.pop()
                if len(piece[2]) > left:
                    head, piece = self._cut(piece, len(piece[2]) - left)
                    items.append(head)
                left -= len(piece[2])
                while len(piece[2]) > length:
                    head, piece = self._cut(piece, length)
                    fine.append(head)
                fine.append(piece)
        items += fine
        at, k = pack(np.array([len(p[2]) for p in items], np.int64), self.capacity)
        used = [0] * k
        for i in np.argsort(at, kind="stable").tolist():
            w = int(at[i])
            self._place(items[i], self.next + w, used[w])
            used[w] += len(items[i][2])
        self.next += k

    def finish(self) -> None:
        while self.total >= self.capacity:
            self._flush(min(self.group, self.total // self.capacity))
        while self.total:
            size = 1 << (self.total.bit_length() - 1)
            used = 0
            for piece in self._take(size):
                self._place(piece, self.next, used)
                used += len(piece[2])
            self.next += 1


def pack_documents(df: DataFrame, text: str = "text", id_col: str = "doc_id", path: str | None = None,
                   capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one piece that holds the end id alone. Repeated rows are packed each.
    Other columns are ignored; an empty table gives no pieces. Placement follows the order of rows in an
    input partition, so the same files in the same partitions give the same sequences.
    """
    ship(df.sparkSession)
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, packer = encoder(path), _Packer(capacity, group, TaskContext.get().partitionId())
        end = np.array([end_id], "<u4")

        def rows() -> pa.RecordBatch:
            got, packer.rows = packer.rows, []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got)], names=names)

        for batch in batches:
            docs = iter(batch.column(0).to_pylist())
            for texts in byte_batches(batch.column(1).to_pylist()):
                for ids in enc.ids(texts):
                    packer.add(next(docs), np.concatenate([ids, end]).astype("<u4", copy=False))
                if len(packer.rows) > 20_000:
                    yield rows()
        packer.finish()
        if packer.rows:
            yield rows()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    t = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return t.mapInArrow(lean(run, "tokens"), PIECES)
