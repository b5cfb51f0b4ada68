"""Packing documents into training sequences: best-fit decreasing over a segment tree.

Documents longer than a window are first cut into full windows; what remains of each document
(less than a window) is placed, longest first, into the open window with the least room that
still holds it. A segment tree over the remaining capacities finds that window. Windows that stay
open at the end of a group are topped up from the emptiest ones, and the single window then left
over is cut into sequences whose lengths are powers of two, since those need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from verigrid.llm.common import give_back, parts, slices, texts_of
from verigrid.llm.tokens import encoder

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
)


class OpenWindows:
    """Windows by remaining capacity, with a segment tree over the capacities that occur."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, window: int, room: int) -> None:
        self.at[room].append(window)
        node = room + self.size
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (window, room) with the least room of at least ``length``."""
        tree, node = self.tree, length + self.size
        if not tree[node]:
            # climb until a right neighbour holds a window, then go down on its left side
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.size
        while node:
            tree[node] -= 1
            node >>= 1
        return self.at[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows as lists of item numbers; equal lengths keep their order."""
    windows: list[list[int]] = []
    free = OpenWindows(capacity)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = free.take(lengths[item])
        if found is None:
            windows.append([item])
            window, room = len(windows) - 1, capacity
        else:
            window, room = found
            windows[window].append(item)
        if room > lengths[item]:
            free.add(window, room - lengths[item])
    return windows


def close_windows(windows: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Top up open windows from the emptiest ones; pieces are (item, start, length).

    Every result is full, or as long as a power of two, so none is padded.
    """
    fill = [sum(p[2] for p in w) for w in windows]
    done = [w for w, n in zip(windows, fill, strict=True) if n == capacity]
    order = sorted((i for i, n in enumerate(fill) if n < capacity), key=lambda i: -fill[i])
    low, high = 0, len(order) - 1
    while low < high:
        taker, giver = windows[order[low]], windows[order[high]]
        item, start, length = giver.pop()
        part = min(capacity - fill[order[low]], length)
        taker.append((item, start, part))
        fill[order[low]] += part
        if part < length:
            giver.append((item, start + part, length - part))
        if not giver:
            high -= 1
        if fill[order[low]] == capacity:
            done.append(taker)
            low += 1
    if low == high:
        done += powers_of_two(windows[order[low]], capacity)
    return done


def powers_of_two(pieces: list[tuple[int, int, int]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Cut one window into sequences whose lengths are the binary digits of its length."""
    rest, out = list(reversed(pieces)), []
    total = sum(p[2] for p in pieces)
    for size in (1 << k for k in reversed(range(capacity.bit_length()))):
        if total & size:
            sequence, need = [], size
            while need:
                item, start, length = rest.pop()
                part = min(need, length)
                sequence.append((item, start, part))
                need -= part
                if part < length:
                    rest.append((item, start + part, length - part))
            out.append(sequence)
    return out


def pack(
    docs: DataFrame, vocabulary_path: str, end_id: int, spaced: bool = False, capacity: int = 2048,
    group: int = 4_000_000, most: int = 150_000, room: int = 4_000_000,
) -> DataFrame:
    """Encode every text and pack it; one row per piece (schema ``PIECES``).

    A group is a run of documents of one partition with about ``group`` ids left after full windows
    are cut off, so memory is bounded and nothing is shuffled; ``sequence_id`` holds the partition
    in its upper half. ``ids`` are little-endian unsigned 32-bit integers. A null or empty text is
    a document of the end id alone, repeated rows are packed each, an empty table gives no rows,
    other columns are ignored. One document's ids must fit in a task's memory; ``most`` and ``room``
    bound the worker's two tables of known words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary_path, spaced, most=most, room=room)
        following = TaskContext.get().partitionId() << 32
        rest: list[tuple] = []  # document, first id kept, all ids of the document, what is left of them
        waiting = 0

        def rows(out: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out, strict=True))
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        def settle() -> Iterator[pa.RecordBatch]:
            nonlocal following, waiting
            lengths = [len(r[3]) for r in rest]
            windows = [[(i, 0, lengths[i]) for i in w] for w in best_fit_decreasing(lengths, capacity)]
            out: list[tuple] = []
            for window in close_windows(windows, capacity):
                offset = 0
                for item, start, length in window:
                    doc, first, total, ids = rest[item]
                    part = ids[start : start + length].astype("<u4").tobytes()
                    out.append((doc, first + start, length, part, total, following, offset))
                    offset += length
                following += 1
                if len(out) >= 512:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)
            rest.clear()
            waiting = 0
            give_back()

        for batch in parts(batches):
            ids_of_docs, texts = batch.column(0).to_pylist(), texts_of(batch)
            for a, b in slices(texts, 1_000_000):
                ids, counts = words.encode(texts[a:b])
                ends = np.cumsum(counts + 1)
                ids = np.insert(ids, np.cumsum(counts), end_id)
                full: list[tuple] = []
                for doc, end, total in zip(ids_of_docs[a:b], ends.tolist(), (counts + 1).tolist(), strict=True):
                    own = ids[end - total : end]
                    cut = total - total % capacity
                    for start in range(0, cut, capacity):
                        part = own[start : start + capacity].astype("<u4").tobytes()
                        full.append((doc, start, capacity, part, total, following, 0))
                        following += 1
                    if cut < total:
                        rest.append((doc, cut, total, own[cut:].astype(np.uint32)))
                        waiting += total - cut
                if full:
                    yield rows(full)
                if waiting >= group:
                    yield from settle()
        if rest:
            yield from settle()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)
