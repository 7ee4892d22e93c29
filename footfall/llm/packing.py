"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

Every document is tokenized and closed with the end id. A document's whole windows stand alone.
What is left over (shorter than a window) is cut into pieces of at most ``piece`` ids and
gathered, in the order of the input split, into blocks of ``windows`` windows less a little
slack. Within a block the pieces are dealt by Karmarkar-Karp differencing: the two partial
partitions with the largest imbalances are merged so that the fullest windows of one meet the
emptiest of the other. If the fullest window exceeds the capacity, the window count rises by one
and the block is dealt again.

There is no shuffle: each input split packs its own documents, so a lost task repeats alone and
gives the same sequences, and the padding is the slack plus less than one window per split.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from footfall.llm import text as T
from footfall.llm.byte_tokens import ByteTokens

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item such that the windows' sums are nearly equal.

    Karmarkar-Karp: each item starts as a partition with one filled window. The two partitions
    with the largest spread (fullest less emptiest window) are merged, fullest on emptiest,
    until one is left. Ties go to the partition made first.
    """
    n = len(sizes)
    if windows == 1 or n <= 1:
        return np.zeros(n, np.int64)
    sums: dict[int, np.ndarray] = {}
    heap = []
    for i, size in enumerate(sizes.tolist()):
        sums[i] = np.zeros(windows, np.int64)
        sums[i][-1] = size
        heap.append((-size, i))
    heapq.heapify(heap)
    merges = []  # (left, right, order): slot s of the merged one holds left's and right's slots
    made = n
    while len(heap) > 1:
        _, left = heapq.heappop(heap)
        _, right = heapq.heappop(heap)
        joined = sums.pop(left) + sums.pop(right)[::-1]
        order = np.argsort(joined, kind="stable")
        joined = joined[order]
        merges.append((left, right, order))
        sums[made] = joined
        heapq.heappush(heap, (int(joined[0] - joined[-1]), made))
        made += 1
    # From the last merge down: the final window of each slot.
    place = {made - 1: np.arange(windows)}
    for k in range(len(merges) - 1, -1, -1):
        left, right, order = merges[k]
        own = np.empty(windows, np.int64)
        own[order] = place.pop(n + k)
        place[left], place[right] = own, own[::-1]
    return np.fromiter((place[i][-1] for i in range(n)), np.int64, n)


def deal(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Windows for items of at most ``capacity``; their count rises until none exceeds it."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        at = differencing(sizes, windows)
        if np.bincount(at, sizes, windows).max(initial=0) <= capacity:
            return at, windows
        windows += 1


class _Packer:
    """Packs the documents of one split; ``out`` holds the pieces that have their place."""

    def __init__(self, split: int, capacity: int, windows: int, piece: int, slack: int) -> None:
        self.capacity, self.piece = capacity, piece
        self.block = windows * capacity - slack
        self.next_id = split << 33
        self.pieces: list[tuple] = []
        self.held = 0
        self.out: list[tuple] = []

    def add(self, doc_id: int, ids: bytes, start: int, length: int, total: int) -> None:
        piece = ids[4 * start:4 * (start + length)]
        self.pieces.append((doc_id, start, length, piece, total))
        self.held += length

    def document(self, doc_id: int, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= self.capacity:
            window = ids[4 * start:4 * (start + self.capacity)]
            self.out.append((doc_id, start, self.capacity, window, total, self.next_id, 0))
            self.next_id += 1
            start += self.capacity
        while start < total:
            # The last piece of a block is cut to fill it.
            length = min(self.piece, total - start, self.block - self.held)
            self.add(doc_id, ids, start, length, total)
            start += length
            if self.held == self.block:
                self.close()

    def close(self) -> None:
        if not self.pieces:
            return
        sizes = np.array([p[2] for p in self.pieces], np.int64)
        at, windows = deal(sizes, self.capacity)
        filled = [0] * windows
        for place, piece in zip(at.tolist(), self.pieces, strict=True):
            self.out.append((*piece, self.next_id + place, filled[place]))
            filled[place] += piece[2]
        self.next_id += windows
        self.pieces, self.held = [], 0


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0,
         windows: int = 128, piece: int = 256, slack: int = 128) -> DataFrame:
    """The pieces of all documents with their ids, sequence and offset.

    ``ids`` are little-endian unsigned 32-bit integers; ``offset`` is the piece's place in its
    sequence, gapless from 0; a sequence is padded up to ``capacity`` by its reader.
    ``tokenizer``: path of a byte-level tokenizers file, readable on every executor.
    ``capacity``: ids in a window; ``windows``, ``piece``, ``slack``: see the module.

    A null or empty text is its end id alone; a null doc_id is packed like any other; repeated
    rows are packed once each. Extra columns are ignored; an empty table gives no rows.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ByteTokens.at(tokenizer)
        end = np.uint32(end_id).tobytes()
        packer = _Packer(TaskContext.get().partitionId(), capacity, windows, piece, slack)
        names = [f.split()[0] for f in SCHEMA.split(", ")]

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*packer.out, strict=True)) or [()] * len(names)
            packer.out = []
            return pa.record_batch([pa.array(c, pa.binary() if n == "ids" else pa.int64())
                                    for n, c in zip(names, columns, strict=True)], names=names)

        for batch in T.rows(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    strict=True):
                packer.document(doc_id, encode(text) + end)
            if len(packer.out) >= 4096:
                yield flushed()
        packer.close()
        yield flushed()

    return T.texts(docs).mapInArrow(packed, SCHEMA)
