"""Exact substring removal over a sparse suffix array, merged from front-coded runs.

Every string of ``length`` bytes holds an anchor: the ``seed``-byte string with the least hash in it,
chosen by content alone, so equal strings have equal anchors. Only suffixes at anchors are sorted.

1. Anchors. Each block of documents sends the sorted, delta-coded run of its anchors' fingerprints to
   buckets; fingerprints that two documents hold are marked in a bitmap of fixed size. It only spares
   work: an anchor it lets through in vain finds no partner later.
2. Runs. Each block sorts the suffixes at marked anchors and sends them, front-coded, with the bytes
   before each anchor. A context that several documents of a block share is sent once, for the
   smallest document; for the others it is settled inside the block, so a passage or a copy that a
   third of all documents hold is sent once per block.
3. Merge. A task takes many buckets, one behind the other. A loser tree merges the runs of a bucket.
   Suffixes carry the length of the prefix they share with the last one out, and only what lies
   behind equal prefixes is compared. Suffixes of one anchor stand together; inside such a group
   every window of ``length`` bytes around the anchor is compared, and windows that a smaller
   document holds give one removed interval per anchor. Intervals of all buckets of a task, and
   those settled inside blocks, are joined per document and sent delta-coded, a row for each slot
   of documents.
4. Removal. Slots give each document its intervals, joined where they overlap; the rest is hashed.

Documents equal to a smaller one are removed whole by their hash.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verigrid.llm.common import give_back, stage
from verigrid.llm.jaccard import id_filter

_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
INTERVALS = "doc_id bigint, starts array<bigint>, ends array<bigint>"


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if cls.up.size < n:
            size = 1 << n.bit_length()
            cls.up, cls.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]), dtype=np.uint64)
                for b in (_BASE, _BACK)
            )
        return cls.up, cls.down


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all strings of ``width`` bytes."""
    up, down = Powers.get(data.size + 1)
    sums = np.zeros(data.size + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: data.size], out=sums[1:])
    h = (sums[width:] - sums[:-width]) * down[: data.size - width + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) over each ``width`` neighbours, by doubling."""
    out, reach = values, 1
    while 2 * reach <= width:
        out, reach = best(out[:-reach], out[reach:]), 2 * reach
    rest = width - reach
    return best(out[: out.size - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, ends: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints of the anchors of documents that lie end to end in ``data``."""
    none = np.empty(0, np.int64), np.empty(0, np.uint64)
    if data.size < length:
        return none
    width = length - seed + 1
    hashes = window_hashes(data, seed) | np.uint64(1)
    least = sliding(hashes, width, np.minimum)  # one per string of `length` bytes
    at = np.arange(least.size)
    following = ends[np.searchsorted(ends, at, side="right")]
    least[at + length > following] = 0  # strings across two documents do not count
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    places = np.flatnonzero(sliding(padded, width, np.maximum) == hashes)
    return places, hashes[places]


class Block:
    """Documents of one task whose texts are looked at together; equal texts once, for the smallest id."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.texts: list[bytes] = []
        self.known: dict[bytes, int] = {}
        self.size = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        data = (text or "").encode()
        if doc_id is None or not data:
            return
        key = hashlib.blake2b(data, digest_size=16).digest()
        if key in self.known:
            at = self.known[key]
            self.ids[at] = min(self.ids[at], doc_id)
            return
        self.known[key] = len(self.ids)
        self.ids.append(doc_id)
        self.texts.append(data)
        self.size += len(data)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum([len(t) for t in self.texts])
        return np.frombuffer(b"".join(self.texts), np.uint8), ends, np.array(self.ids, np.int64)


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Block]:
    block = Block()
    for batch in batches:
        for first in range(0, batch.num_rows, 256):  # few texts are Python objects at a time
            part = batch.slice(first, 256)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                block.add(doc_id, text)
                if block.size >= size:
                    yield block
                    block = Block()
                    give_back()
    if block.ids:
        yield block


def block_anchors(block: Block, length: int, seed: int, part: int = 500_000):
    """Anchors of a block (places, document numbers, fingerprints), a part of its bytes at a time."""
    data, ends, ids = block.joined()
    starts = np.concatenate([[0], ends[:-1]])
    places, prints, first = [], [], 0
    while first < ends.size:
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + part)))
        a, b = starts[first], ends[last - 1]
        p, f = anchors(data[a:b], ends[first:last] - a, length, seed)
        places.append(p + a)
        prints.append(f)
        first = last
    place = np.concatenate(places)
    return data, starts, ends, ids, place, np.searchsorted(ends, place, side="right"), np.concatenate(prints)


def pack_run(prints: np.ndarray) -> bytes:
    """Sorted fingerprints (upper 48 bits) as differences, byte planes, zstd."""
    deltas = np.diff(prints >> np.uint64(16), prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(deltas.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack_run(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def bucket_of(prints: np.ndarray, buckets: int, width: int) -> np.ndarray:
    """Buckets of anchors, equally full though anchors have small hashes.

    A byte whose hash is x is the least of some ``width`` in a row with chance q**(width - 1) *
    (1 + (width - 1) * x), where q = 1 - x; buckets are equal parts of that distribution. Only
    products are used, so that every machine finds the same bucket.
    """
    q = 1 - (prints >> np.uint64(11)) / float(1 << 53)
    above, base, n = (width + 1) / 2 - (width - 1) / 2 * q, q, width
    while n:
        if n & 1:
            above = above * base
        base = base * base
        n >>= 1
    return np.clip((1 - above) * buckets, 0, buckets - 1).astype(np.int64)


def shared_anchors(docs: DataFrame, length: int, seed: int, size: int, buckets: int, bits: int) -> np.ndarray:
    """Bitmap of fingerprints that two documents hold; 2**bits bits whatever the corpus."""
    width = length - seed + 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, size):
            *_, owner, prints = block_anchors(block, length, seed)
            order = np.lexsort((owner, prints, bucket_of(prints, buckets, width)))
            prints, owner = prints[order], owner[order]
            new = np.ones(prints.size, bool)
            new[1:] = (prints[1:] != prints[:-1]) | (owner[1:] != owner[:-1])
            prints = prints[new]
            start = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])[: prints.size])
            counts = np.minimum(np.diff(np.append(start, prints.size)), 2)  # twice tells enough
            prints = np.repeat(prints[start], counts)
            cuts = np.searchsorted(bucket_of(prints, buckets, width), np.arange(buckets + 1))
            runs = [(k, pack_run(prints[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
            if runs:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in runs], pa.int32()), pa.array([r[1] for r in runs], pa.binary())], ["bucket", "run"])

    def meet(table: pa.Table) -> pa.Table:
        prints = np.sort(np.concatenate([unpack_run(r) for r in table.column("run").to_pylist()]))
        slots = np.unique(prints[1:][prints[1:] == prints[:-1]] & np.uint64((1 << bits) - 1))
        words, at = np.unique(slots >> np.uint64(5), return_inverse=True)
        values = np.zeros(words.size, np.int64)
        np.bitwise_or.at(values, at, np.int64(1) << (slots & np.uint64(31)).astype(np.int64))
        return pa.table([pa.array(words.astype(np.int64)), pa.array(values)], ["w", "b"])

    runs = docs.mapInArrow(send, "bucket int, run binary").repartition(buckets, "bucket")
    words = runs.groupBy("bucket").applyInArrow(meet, "w bigint, b bigint").groupBy("w").agg(F.bit_or("b").alias("b"))
    table = words.toArrow()  # at most 2**(bits - 5) rows
    bitmap = np.zeros(1 << (bits - 5), np.uint32)
    bitmap[table.column("w").to_numpy()] = table.column("b").to_numpy().astype(np.uint32)
    return bitmap


def contexts(data, starts, ends, place, owner, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes around anchors, zero-padded at document ends, and how many are real on either side."""
    left, width = length - seed, 2 * length - seed
    lefts = np.minimum(place - starts[owner], left)
    rights = np.minimum(ends[owner] - place, length)
    column = np.arange(width) - left
    at = np.clip(place[:, None] + column, 0, data.size - 1)
    real = (column >= -lefts[:, None]) & (column < rights[:, None])
    return np.where(real, data[at], np.uint8(0)), lefts, rights


def order_of(rows: np.ndarray, columns: slice) -> np.ndarray:
    """Ascending order of rows of bytes by the named columns first, then all."""
    def words(x):
        padded = np.zeros((len(x), -(-x.shape[1] // 8) * 8), np.uint8)
        padded[:, : x.shape[1]] = x
        return padded.view(">u8").astype(np.uint64)

    keys = np.concatenate([words(rows[:, columns]), words(rows[:, : columns.start])], axis=1)
    return np.lexsort(keys.T[::-1])


def front_code(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Shared prefix lengths with the row before, and the bytes behind them."""
    differ = rows[1:] != rows[:-1]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1]) if len(rows) > 1 else []
    prefix = np.concatenate([[0], prefix]).astype(np.uint8)[: len(rows)]
    return prefix, rows[np.arange(rows.shape[1]) >= prefix[:, None]].tobytes()


def write_run(rows, lefts, rights, docs, counts, places, left: int) -> bytes:
    """A sorted run: front-coded suffixes, bytes before them, documents and places."""
    prefix, rest = front_code(rows[:, left:])
    parts = [prefix.tobytes(), rest, np.ascontiguousarray(rows[:, :left].T).tobytes(), lefts.astype(np.uint8).tobytes(), rights.astype(np.uint8).tobytes(),
             docs.astype("<i8").tobytes(), counts.astype("<i4").tobytes(), places.astype("<i8").tobytes()]
    return zstandard.compress(struct.pack("<9q", len(rows), *map(len, parts)) + b"".join(parts), 1)


class Run:
    """A run as it arrives; suffixes are decoded one behind the other, when the merge asks for them."""

    def __init__(self, data: bytes, left: int, length: int):
        raw = zstandard.decompress(data)
        self.count, *sizes = struct.unpack_from("<9q", raw)
        at, parts = 72, []
        for size in sizes:
            parts.append(raw[at : at + size])
            at += size
        self.prefix, self.rest, before, lefts, rights, docs, counts, places = parts
        self.length, self.at, self.last = length, 0, b""
        self.decoded = bytearray()
        self.before = np.frombuffer(before, np.uint8).reshape(left, self.count).T
        self.lefts, self.rights = (np.frombuffer(x, np.uint8) for x in (lefts, rights))
        self.docs, self.counts, self.places = (np.frombuffer(x, t) for x, t in ((docs, "<i8"), (counts, "<i4"), (places, "<i8")))

    def suffix(self, i: int) -> int:
        """The i-th suffix as one big-endian number, so whole prefixes compare at once; asked for in order."""
        shared = self.prefix[i]
        end = self.at + self.length - shared
        self.last = self.last[:shared] + self.rest[self.at : end]
        self.at = end
        self.decoded += self.last
        return int.from_bytes(self.last)

    def write_rows(self, out: np.ndarray) -> None:
        """Contexts of a merged run; what they were decoded from is let go."""
        left = self.before.shape[1]
        out[:, :left] = self.before
        out[:, left:] = np.frombuffer(self.decoded, np.uint8).reshape(self.count, self.length)
        self.before, self.decoded, self.rest, self.prefix = self.before[:0], bytearray(), b"", b""


def merge(runs: list[Run], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of all suffixes as (run, place in run) with the prefix shared with the one before.

    A loser tree whose nodes hold, beside the losing run, the prefix its suffix shares with the last
    suffix out. Of two candidates the one that shares more is smaller; only at equal lengths are the
    suffixes compared, and the loser keeps the newly found length.
    """
    size = 1 << max(1, (len(runs) - 1).bit_length())
    counts = [r.count for r in runs] + [0] * (size - len(runs))
    at = [0] * size
    end = 1 << (8 * length)  # larger than any suffix
    now = [runs[k].suffix(0) if n else end for k, n in enumerate(counts)]
    shares = [0] * size
    losers = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of runs a and b; the loser's prefix is brought up to date."""
        sa, sb = shares[a], shares[b]
        if sa != sb:
            return (a, b) if sa > sb else (b, a)
        x, y = now[a], now[b]
        if x == y:
            shares[b] = length
            return a, b
        common = length - ((x ^ y).bit_length() + 7) // 8 if x < end and y < end else 0
        if x < y:
            shares[b] = common
            return a, b
        shares[a] = common
        return b, a

    def build(node: int) -> int:
        if node >= size:
            return node - size
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    total = sum(counts)
    out_run, out_at, out_share = (np.empty(total, t) for t in (np.int32, np.int32, np.uint8))
    best = build(1)
    for k in range(total):
        out_run[k], out_at[k], out_share[k] = best, at[best], shares[best]
        at[best] += 1
        i = at[best]
        if i < counts[best]:
            now[best], shares[best] = runs[best].suffix(i), runs[best].prefix[i]
        else:
            now[best], shares[best] = end, -1  # loses against all that is left
        node = (best + size) >> 1
        while node:
            best, losers[node] = play(best, losers[node])
            node >>= 1
    return out_run, out_at, out_share


def held_before(rows, lefts, rights, docs, groups, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest offset of a window around each anchor that a smaller document holds (-1: none)."""
    offsets = length - seed + 1
    up, down = Powers.get(rows.shape[1] + 1)
    sums = np.zeros((len(rows), rows.shape[1] + 1), np.uint64)
    np.cumsum(_BYTES[rows] * up[: rows.shape[1]], axis=1, out=sums[:, 1:])
    first = np.arange(offsets)[::-1]  # the window at offset o starts o bytes before the anchor
    hashes = (sums[:, first + length] - sums[:, first]) * down[first]
    offset = np.arange(offsets)
    real = (lefts[:, None] >= offset) & (rights[:, None] >= length - offset)
    tag = (groups[:, None].astype(np.uint64) * np.uint64(offsets) + offset.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    key = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) ^ tag
    r, o = np.nonzero(real)
    key, doc = key[r, o], docs[r]
    order = np.argsort(key, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if order.size else order
    least = np.minimum.reduceat(doc[order], start) if order.size else doc
    smallest = np.empty(order.size, np.int64)
    smallest[order] = np.repeat(least, np.diff(np.append(start, order.size)))
    low, high = np.full(len(rows), length, np.int64), np.full(len(rows), -1, np.int64)
    seen = smallest < doc
    np.minimum.at(low, r[seen], o[seen])
    np.maximum.at(high, r[seen], o[seen])
    return low, high


def united(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals in the order of documents and starts; those of a document that meet become one."""
    if not docs.size:
        return docs, starts, ends
    order = np.lexsort((starts, docs))
    docs, starts, ends = docs[order], starts[order], ends[order]
    other = np.concatenate([[True], docs[1:] != docs[:-1]])
    above = np.cumsum(other) * (ends.max() + 1)  # the ends of a document lie above those of all before it
    reach = np.maximum.accumulate(ends + above) - above
    first = np.flatnonzero(other | np.concatenate([[True], starts[1:] > reach[:-1]]))
    return docs[first], starts[first], reach[np.append(first[1:], docs.size) - 1]


def by_document(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Intervals as one row per document, joined where they meet."""
    docs, starts, ends = united(docs, starts, ends)
    cuts = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if docs.size else docs
    edges = np.append(cuts, docs.size)
    for k in range(0, cuts.size, rows):
        a, b, own = edges[k], edges[min(k + rows, cuts.size)], edges[k : k + rows + 1]
        lists = [pa.ListArray.from_arrays(pa.array(own - a, pa.int32()), pa.array(x[a:b])) for x in (starts, ends)]
        yield pa.RecordBatch.from_arrays([pa.array(docs[own[:-1]]), *lists], ["doc_id", "starts", "ends"])


def pack_intervals(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Intervals in the order of documents: differences, starts and lengths as byte planes, zstd."""
    columns = np.stack([np.diff(docs, prepend=0), starts, ends - starts]).astype("<i8")
    return zstandard.compress(np.ascontiguousarray(columns.view(np.uint8).reshape(3, -1, 8).transpose(0, 2, 1)).tobytes(), 1)


def unpack_intervals(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(3, 8, -1)
    docs, starts, lengths = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8").reshape(3, -1)
    return np.cumsum(docs), starts, starts + lengths


def slots_of(docs: np.ndarray, slots: int) -> np.ndarray:
    mixed = docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)


class Intervals:
    """Removed intervals that a task has found so far."""

    def __init__(self) -> None:
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        if docs.size:
            self.found.append(united(docs, starts, ends))
            self.size += self.found[-1][0].size

    def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All of them, joined per document; none are held any longer."""
        nothing = (np.empty(0, np.int64),) * 3
        found = united(*map(np.concatenate, zip(nothing, *self.found, strict=True)))
        self.found, self.size = [], 0
        return found

    def packed(self, slots: int) -> Iterator[pa.RecordBatch]:
        docs, starts, ends = self.taken()
        if docs.size:
            slot = slots_of(docs, slots)
            order = np.argsort(slot, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], np.diff(slot[order]) > 0, [True]]))
            own = [order[a:b] for a, b in zip(edges, edges[1:], strict=False)]
            rows = [pack_intervals(docs[x], starts[x], ends[x]) for x in own]
            yield pa.RecordBatch.from_arrays([pa.array(slot[order][edges[:-1]], pa.int32()), pa.array(rows, pa.binary())], ["slot", "cuts"])


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, disjoint intervals that cover the same bytes; touching ones become one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    first = np.flatnonzero(new)
    return starts[first], ends[np.append(first[1:], starts.size) - 1]


def runs_of(docs: DataFrame, bitmap, length: int, seed: int, size: int, buckets: int, bits: int) -> DataFrame:
    """Rows with a ``run`` of a ``bucket``; one row per block has ``cuts`` settled inside it, in any bucket."""
    left = length - seed

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bitmap.value
        for block in blocks(batches, size):
            data, starts, ends, ids, place, owner, prints = block_anchors(block, length, seed)
            slot = (prints >> np.uint64(16)) & np.uint64((1 << bits) - 1)
            hit = held[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32) & 1 == 1
            place, owner, prints = place[hit], owner[hit], prints[hit]
            bucket = bucket_of(prints, buckets, left + 1)
            cuts = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[cuts], np.arange(buckets + 1))
            found, settled = [], Intervals()
            for k in np.flatnonzero(np.diff(edges)).tolist():
                mine = cuts[edges[k] : edges[k + 1]]
                p, d = place[mine], owner[mine]
                rows, lefts, rights = contexts(data, starts, ends, p, d, length, seed)
                order = order_of(rows, slice(left, None))
                order = order[np.lexsort((ids[d][order], groups_of(rows[order], lefts[order], rights[order])))]
                rows, lefts, rights, doc, at = rows[order], lefts[order], rights[order], ids[d][order], (p - starts[d])[order]
                group = groups_of(rows, lefts, rights)
                first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
                smallest = doc[first][group]
                later = doc > smallest
                enough = later & (lefts + rights >= length)
                settled.add(doc[enough], (at - lefts)[enough], (at + rights)[enough])
                own = ~later
                counts = np.bincount(group[own], minlength=first.size)
                found.append((k, write_run(rows[first], lefts[first], rights[first], doc[first], counts, at[own], left), None))
            if settled.size:
                found.append((int(slots_of(ids[:1], buckets)[0]), None, pack_intervals(*settled.taken())))
            if found:
                kinds = pa.int32(), pa.binary(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], ["bucket", "run", "cuts"])

    return docs.mapInArrow(send, "bucket int, run binary, cuts binary")


def groups_of(rows: np.ndarray, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
    """Numbers of runs of equal contexts among sorted rows."""
    if not len(rows):
        return np.empty(0, np.int64)
    differ = (rows[1:] != rows[:-1]).any(axis=1) | (lefts[1:] != lefts[:-1]) | (rights[1:] != rights[:-1])
    return np.concatenate([[0], np.cumsum(differ)])


def merge_bucket(runs: list[bytes], length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, starts and ends of what the runs of a bucket remove."""
    left = length - seed
    parts = [Run(data, left, length) for data in runs]
    order_run, order_at, shared = merge(parts, length)
    base = np.cumsum([0, *[p.count for p in parts]])
    order = base[order_run] + order_at
    joined = lambda name: np.concatenate([getattr(p, name) for p in parts])
    lefts, rights, docs, counts = (joined(n) for n in ("lefts", "rights", "docs", "counts"))
    rows = np.empty((order.size, 2 * length - seed), np.uint8)
    for k, part in enumerate(parts):
        part.write_rows(rows[base[k] : base[k + 1]])
    group = np.empty(order.size, np.int64)
    group[order] = np.cumsum(shared < seed)
    low, high = np.empty(order.size, np.int64), np.empty(order.size, np.int64)
    edges = np.flatnonzero(np.concatenate([[True], shared[1:] < seed])) if order.size else []
    a = 0
    while a < order.size:  # whole groups, some thousands of suffixes at a time
        k = int(np.searchsorted(edges, a + 8_000))
        b = int(edges[k]) if k < len(edges) else order.size
        part = order[a:b]
        low[part], high[part] = held_before(rows[part], lefts[part], rights[part], docs[part], group[part], length, seed)
        a = b
    places = joined("places")
    doc, lo, hi = (np.repeat(x, counts) for x in (docs, low, high))
    cut = hi >= 0
    return doc[cut], places[cut] - hi[cut], places[cut] - lo[cut] + length


def packed_intervals(runs: DataFrame, length: int, seed: int, parts: int, most: int = 1_000_000) -> DataFrame:
    """Rows of a ``slot`` of documents and ``cuts``; a task sends a row for each slot, or more beyond ``most`` intervals."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket, own = Intervals(), None, []
        for batch in batches:
            for k, run, cuts in zip(*batch.columns, strict=True):
                if k.as_py() != bucket and own:
                    held.add(*merge_bucket(own, length, seed))
                    own = []
                    give_back()
                bucket = k.as_py()
                if run.is_valid:
                    own.append(run.as_py())
                else:
                    held.add(*unpack_intervals(cuts.as_py()))
                if held.size >= most:
                    yield from held.packed(parts)
        if own:
            held.add(*merge_bucket(own, length, seed))
        yield from held.packed(parts)
        give_back()

    return runs.repartitionById(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "slot int, cuts binary")


def merged_intervals(runs: DataFrame, length: int, seed: int, parts: int) -> DataFrame:
    """One row per document that loses bytes."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Intervals()
        for batch in batches:
            for cuts in batch.column(1):
                held.add(*unpack_intervals(cuts.as_py()))
        yield from by_document(*held.taken())

    return packed_intervals(runs, length, seed, parts).repartitionById(parts, "slot").mapInArrow(gather, INTERVALS)


def remove(docs: DataFrame, length: int = 50, seed: int = 24, size: int = 8_000_000, bits: int = 26) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept`` (text, null if whole).

    Texts are UTF-8 bytes; ``kept`` drops bytes of characters cut in two. Null and empty texts have
    nothing to lose, nor have texts shorter than ``length`` and rows without ``doc_id``, which also
    take nothing from others. Equal rows of one id keep their bytes, since no id is smaller than
    itself; rows come back each. An id stands for one text. Other columns are ignored; an empty
    table gives no rows. ``bits`` sets the size of the bitmaps only.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = stage(docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("sha")), "bytes")
    total = facts.agg(F.sum("n_bytes")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 16_000_000 + 1)
    buckets = max(parts, total // 4_000_000 + 1)  # a task merges one at a time
    bitmap = spark.sparkContext.broadcast(shared_anchors(docs, length, seed, size, parts, bits))  # 2**bits bits
    cut = merged_intervals(runs_of(docs, bitmap, length, seed, size, buckets, bits), length, seed, parts)
    smallest = facts.filter("doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("first"))
    facts = facts.join(smallest, "sha", "left")
    copies = facts.filter(F.col("doc_id") > F.col("first")).select("doc_id").distinct()
    cut = stage(cut.join(copies, "doc_id", "left_anti"), "intervals")
    kept = kept_texts(docs, cut)
    out = facts.join(kept, "doc_id", "left")
    copy = F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n_bytes") >= length), F.lit(False))
    nothing = F.sha2(F.lit(""), 256)
    return out.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, nothing).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )


def kept_texts(docs: DataFrame, cut: DataFrame, bits: int = 24) -> DataFrame:
    """What is left of the documents with intervals; a bitmap leaves most others unshuffled."""
    bitmap = id_filter(cut, "doc_id", bits)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits)).alias("slot")

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column(2).to_numpy()
            rows = np.flatnonzero(bitmap[slots >> 5] >> (slots & 31).astype(np.uint32) & 1)
            yield batch.select([0, 1]).take(pa.array(rows))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, starts, ends in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = (text or "").encode()
                starts, ends = union(np.array(starts, np.int64), np.minimum(np.array(ends, np.int64), len(data)))
                edges = [0, *[int(e) for pair in zip(starts, ends, strict=True) for e in pair], len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((doc_id, len(data) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out, strict=True)], ["doc_id", "n_removed", "n_spans", "kept_sha256", "kept"]) if out else empty

    empty = pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())], ["doc_id", "n_removed", "n_spans", "kept_sha256", "kept"])
    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", slot).mapInArrow(maybe, "doc_id bigint, text string")
    held = texts.dropDuplicates(["doc_id"]).join(cut, "doc_id").select("doc_id", "text", "starts", "ends")
    return held.mapInArrow(rest, "doc_id bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string")
