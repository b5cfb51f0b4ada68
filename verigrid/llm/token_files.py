"""Token-id files: equal-length sequences and masks in Arrow files, read without copying.

A shard holds the ids of documents in ascending id order as one stream, cut into sequences of
``sequence`` ids. Its file is an Arrow IPC file whose batches all hold ``rows`` sequences (the
last may hold fewer): column ``ids`` is a fixed-size list of uint16 (uint32 for vocabularies of
65,536 ids or more), column ``mask`` a fixed-size list of booleans, true where an id is real. The
only padding is behind the last id of a shard. Sequence ``i`` is row ``i % rows`` of batch
``i // rows``, so a memory-mapped file gives any sequence, or any run of ids, as a view. A second
file beside it lists the documents of the shard with their places in the stream.

Each task attempt writes files of its own name and only names from successful attempts enter the
manifest, so lost executors and speculative copies leave no trace in what readers see.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verigrid.llm.common import slices, stage, texts_of
from verigrid.llm.tokens import encoder

MANIFEST = "shard bigint, path string, n_docs bigint, n_tokens bigint, n_sequences bigint"
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def token_type(vocabulary: int) -> pa.DataType:
    return pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()


class ShardWriter:
    """Streams the ids of one shard into its two files; holds one batch at most."""

    def __init__(self, path: str, kind: pa.DataType, sequence: int, rows: int):
        self.files, base = pafs.FileSystem.from_uri(path)
        self.files.create_dir(base.rsplit("/", 1)[0])
        self.kind, self.sequence, self.rows = kind, sequence, rows
        meta = {b"layout": json.dumps({"sequence": sequence, "rows": rows}).encode()}
        self.schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))], meta)
        self.out = self.files.open_output_stream(base)
        self.batches = pa.ipc.new_file(self.out, self.schema)
        self.doc_out = self.files.open_output_stream(base + ".docs")
        self.docs = pa.ipc.new_file(self.doc_out, DOCS)
        self.room = np.empty(sequence * rows, kind.to_pandas_dtype())
        self.held = self.n_tokens = self.n_docs = self.n_sequences = 0

    def _flush(self) -> None:
        if not self.held:
            return
        n = -(-self.held // self.sequence)
        self.room[self.held : n * self.sequence] = 0
        ids = pa.array(self.room[: n * self.sequence].copy(), self.kind)
        mask = pa.array(np.arange(n * self.sequence) < self.held)
        lists = [pa.FixedSizeListArray.from_arrays(x, self.sequence) for x in (ids, mask)]
        self.batches.write_batch(pa.record_batch(lists, schema=self.schema))
        self.n_sequences += n
        self.held = 0

    def write(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        starts = self.n_tokens + np.cumsum(counts) - counts
        self.docs.write_batch(pa.record_batch([doc_ids, pa.array(starts), pa.array(counts)], schema=DOCS))
        self.n_tokens += ids.size
        self.n_docs += len(counts)
        at = 0
        while at < ids.size:
            take = min(ids.size - at, self.room.size - self.held)
            self.room[self.held : self.held + take] = ids[at : at + take]
            self.held += take
            at += take
            if self.held == self.room.size:
                self._flush()

    def close(self) -> None:
        self._flush()
        for x in (self.batches, self.out, self.docs, self.doc_out):
            x.close()


class ShardReader:
    """Random access to a shard: sequences, masks and runs of ids."""

    def __init__(self, path: str):
        self.files, self.base = pafs.FileSystem.from_uri(path)
        local = isinstance(self.files, pafs.LocalFileSystem)
        self.source = pa.memory_map(self.base) if local else self.files.open_input_file(self.base)
        self.batches = pa.ipc.open_file(self.source)
        layout = json.loads(self.batches.schema.metadata[b"layout"])
        self.sequence, self.rows = layout["sequence"], layout["rows"]
        self.at, self.batch = -1, None

    def _batch(self, k: int) -> pa.RecordBatch:
        if k != self.at:
            self.at, self.batch = k, self.batches.get_batch(k)
        return self.batch

    def _flat(self, k: int) -> np.ndarray:
        return self._batch(k).column("ids").flatten().to_numpy(zero_copy_only=True)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of sequence ``i``."""
        k, r = divmod(i, self.rows)
        ids = self._flat(k)[r * self.sequence : (r + 1) * self.sequence]
        mask = self._batch(k).column("mask").slice(r, 1).flatten().to_numpy(zero_copy_only=False)
        return ids, mask

    def run(self, start: int, count: int) -> np.ndarray:
        """``count`` ids of the stream from ``start``; a view if one batch holds them."""
        size, parts = self.sequence * self.rows, []
        while count > 0:
            k, offset = divmod(start, size)
            parts.append(self._flat(k)[offset : offset + count])
            start, count = start + parts[-1].size, count - parts[-1].size
        return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, np.uint16), *parts])

    def docs(self) -> Iterator[pa.RecordBatch]:
        with self.files.open_input_file(self.base + ".docs") as source:
            found = pa.ipc.open_file(source)
            for k in range(found.num_record_batches):
                yield found.get_batch(k)

    def close(self) -> None:
        self.batch = self.batches = None
        self.source.close()


def new_folder(shared: str) -> str:
    """A folder of its own under one that all executors share."""
    return f"{shared}/tokens-{uuid.uuid4().hex}"


def write_tokens(
    docs: DataFrame, folder: str, vocabulary_path: str, vocabulary: int, end_id: int, spaced: bool = True,
    sequence: int = 2048, rows: int = 512,
) -> DataFrame:
    """Encode every text and write the shards; returns the manifest, one row per shard.

    ``docs`` needs ``doc_id`` (long) and ``text``; other columns are ignored. A null or empty text
    has the end id only, a null ``doc_id`` comes first, equal ids keep together in one shard, an
    empty table gives an empty manifest. The folder must be one that all executors share.
    """
    kind = token_type(vocabulary)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        path = f"{folder}/shard-{number:06d}-{uuid.uuid4().hex}.arrow"
        writer, words = None, encoder(vocabulary_path, spaced)
        for batch in batches:
            texts = texts_of(batch)
            for a, b in slices(texts, 1_000_000):
                ids, counts = words.encode(texts[a:b])
                ids = np.insert(ids, np.cumsum(counts), end_id)
                writer = writer or ShardWriter(path, kind, sequence, rows)
                writer.write(batch.column(0).slice(a, b - a), ids, counts + 1)
        if writer:
            writer.close()
            row = [[number], [path], [writer.n_docs], [writer.n_tokens], [writer.n_sequences]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["shard", "path", "n_docs", "n_tokens", "n_sequences"])

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return stage(ordered.mapInArrow(shard, MANIFEST), "token-shards")


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: ``doc_id``, ``start`` over all shards, ``n_tokens``, ``ids``.

    ``ids`` holds the ids as little-endian unsigned 32-bit integers.
    """
    # one row per shard, so this order is small whatever the corpus
    base = F.sum("n_tokens").over(W.orderBy("shard")) - F.col("n_tokens")
    placed = manifest.select("shard", "path", base.alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = ShardReader(row["path"])
                for docs in reader.docs():
                    starts, counts = (docs.column(i).to_numpy() for i in (1, 2))
                    found = [reader.run(s, n).astype("<u4").tobytes() for s, n in zip(starts, counts, strict=True)]
                    columns = [docs.column(0), pa.array(starts + row["base"]), docs.column(2), pa.array(found, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])
                reader.close()

    shards = max(1, manifest.count())
    return placed.repartition(shards, "shard").mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


