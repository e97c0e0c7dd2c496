"""Packing by Karmarkar-Karp multiway differencing.

Documents are encoded, full windows are cut off, and what remains of the documents of a group is dealt into windows,
in pieces of at most half a window; one in FINE remainders is cut into small pieces, which even out the others.
Partial partitions are merged so that their imbalances oppose each other, which gives near-equal windows. The count
of windows begins at the least that can hold the group and rises for as long as any window is over its capacity.

Null texts count as empty (one end id); rows with equal or null ids are packed each for itself; an empty table
gives no rows; only the id and text columns are read.
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

from .common import hold_memory, array_slices
from .tokens import encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Remainders that are packed together; work grows as its square.
GROUP = 384
#: One in so many remainders is cut into pieces of a 64th of a window.
FINE = 16


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Positions of the sizes for each of the ways; the sums are near-equal."""
    if ways == 1:
        return [list(range(len(sizes)))]
    # A partition: loads in descending order (at most one entry a way, zero loads left out) and their members.
    heap = [(-s, i, [(s, (i,))]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) + len(b) <= ways:
            merged = a + b
        else:
            # The largest of one meet the smallest of the other.
            a, b = (a, b) if len(a) >= len(b) else (b, a)
            free = ways - len(a)
            keep = len(a) - (len(b) - free)
            merged = a[:keep] + b[:free]
            merged += [(x + y, m + n) for (x, m), (y, n) in zip(a[keep:], reversed(b[free:]))]
        merged.sort(key=lambda x: -x[0])
        low = merged[-1][0] if len(merged) == ways else 0
        serial += 1
        heapq.heappush(heap, (-(merged[0][0] - low), serial, merged))
    out = [list(m) for _, m in heap[0][2]] if heap else []
    return out + [[] for _ in range(ways - len(out))]


def cut_up(sizes: list[int], capacity: int) -> list[tuple[int, int, int]]:
    """(position, begin, length) of near-equal pieces of each item."""
    out = []
    for i, n in enumerate(sizes):
        parts = -(-n // max(1, capacity // (64 if i % FINE == 0 else 2)))
        bounds = [n * k // parts for k in range(parts + 1)] if parts else [0]
        out += [(i, a, b - a) for a, b in zip(bounds, bounds[1:])]
    return out


def windows(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (position, begin, length) pieces; every item lies wholly in them, no window exceeds the capacity."""
    pieces = cut_up(sizes, capacity)
    lengths = [n for _, _, n in pieces]
    ways = -(-sum(lengths) // capacity)
    while ways:
        found = differencing(lengths, ways)
        if all(sum(lengths[i] for i in members) <= capacity for members in found):
            return [joined([pieces[i] for i in members]) for members in found if members]
        ways += 1
    return []


def joined(pieces: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """In ascending order; pieces that follow each other in their item are one."""
    out: list[tuple[int, int, int]] = []
    for i, begin, length in sorted(pieces):
        if out and out[-1][0] == i and out[-1][1] + out[-1][2] == begin:
            out[-1] = (i, out[-1][1], out[-1][2] + length)
        else:
            out.append((i, begin, length))
    return out


class Packer:
    """Collects the documents of one task and emits packed pieces."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.next, self.rest, self.rows = capacity, first, [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        full = len(ids) // self.capacity * self.capacity
        for a in range(0, full, self.capacity):
            self._piece(doc_id, a, ids[a : a + self.capacity], len(ids), self.next, 0)
            self.next += 1
        if full < len(ids):
            self.rest.append((doc_id, full, ids[full:].copy(), len(ids)))
        if len(self.rest) >= GROUP:
            self.pack()

    def pack(self) -> None:
        for window in windows([len(x[2]) for x in self.rest], self.capacity):
            at = 0
            for i, begin, length in window:
                doc_id, start, ids, total = self.rest[i]
                self._piece(doc_id, start + begin, ids[begin : begin + length], total, self.next, at)
                at += length
            self.next += 1
        self.rest = []

    def _piece(self, doc_id, start, ids, total, sequence, at) -> None:
        self.rows.append((doc_id, start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")), total, sequence, at, ids))

    def take(self, with_ids: bool) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * 8
        self.rows = []
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        arrays = [pa.array(x, pa.int64()) for x in columns[:7]]
        if with_ids:
            arrays, names = [*arrays, pa.array(columns[7], pa.list_(pa.int32()))], [*names, "ids"]
        return pa.RecordBatch.from_arrays(arrays, names=names)


def pack(docs: DataFrame, tokenizer: str, *, end_id: int, capacity: int = 2048, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece; with_ids adds its token ids. No shuffle: each task packs what it reads.

    sequence_id has the task's number in its upper bits, so it is unique and the same when a task is repeated.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_memory("encoder", encoder.cache_clear)
        own, packer = encoder(tokenizer), Packer(capacity, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], np.int32)
        for rows, texts in array_slices(batches, "text"):
            ids, sizes = own.encode(texts)
            ends = np.cumsum(sizes)
            for doc_id, a, b in zip(rows.column("doc_id").to_pylist(), ends - sizes, ends):
                packer.add(doc_id, np.concatenate([ids[a:b], end]))
            yield packer.take(with_ids)
        packer.pack()
        yield packer.take(with_ids)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, SCHEMA + ", ids array<int>" * with_ids)
