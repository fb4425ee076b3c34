"""Token-id files: ids bit-packed at the least fixed width of the vocabulary.

A file holds consecutive documents. Its parts, all little-endian::

    magic 8 bytes | width, ids per block: uint32 | ids, documents, blocks: uint64
    doc ids: int64 per document | place of each document's first id, and of the end: uint64
    byte offset of each block in the payload, and of the end: uint64 | payload

Sixty-four ids fill ``width`` words of 64 bits, so numpy packs and unpacks whole columns of
lanes at once. A range of ids is read through the block offsets alone.

Texts are range-partitioned and sorted by ``doc_id``; each task writes files of bounded size to
the shared folder, under names of its own attempt, and gives a manifest row for each. The
manifest is committed as a table, so files of lost attempts are never read.

Defined cases: a null text is empty and has its end id only; null ids come first and are
stored as the least 64-bit integer; repeated rows are stored each, ties in the order of their
text's hash; an empty table has no files; extra columns are not stored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import kept, slices, whole_text
from corpusmill.llm.token_ids import encoder
from corpusmill.operators.ranks import block_offsets
from corpusmill.session import scratch_path

MAGIC = b"PACKIDS1"
HEAD = "<8sIIQQQ"
LANES = 64
BLOCK = 4096
FILE_IDS = 8 << 20
NO_ID = -(1 << 63)
MANIFEST = "part int, number int, file string, n_docs long, n_ids long"


def width_of(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    rows = -(-len(ids) // LANES)
    lanes = np.zeros(rows * LANES, np.uint64)
    lanes[: len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.reshape(rows, LANES).T)
    words = np.zeros((width, rows), np.uint64)
    for j in range(LANES):
        k, shift = divmod(j * width, 64)
        words[k] |= lanes[j] << np.uint64(shift)
        if shift + width > 64:
            words[k + 1] |= lanes[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").tobytes()


def unpack(payload: bytes, n: int, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.frombuffer(payload, "<u8").reshape(-1, width).T)
    mask = np.uint64((1 << width) - 1)
    lanes = np.empty((LANES, words.shape[1]), np.uint32)
    for j in range(LANES):
        k, shift = divmod(j * width, 64)
        found = words[k] >> np.uint64(shift)
        if shift + width > 64:
            found = found | words[k + 1] << np.uint64(64 - shift)
        lanes[j] = found & mask
    return np.ascontiguousarray(lanes.T).ravel()[:n]


def file_bytes(doc_ids: list[int | None], texts: list[np.ndarray], width: int) -> Iterator[bytes]:
    flat = np.concatenate(texts) if texts else np.empty(0, np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype("<u8")
    blocks = -(-len(flat) // BLOCK)
    full = BLOCK // LANES * width * 8
    offsets = np.arange(blocks + 1, dtype="<u8") * np.uint64(full)
    payload = pack(flat, width)
    offsets[-1] = len(payload)
    yield struct.pack(HEAD, MAGIC, width, BLOCK, len(flat), len(doc_ids), blocks)
    yield np.array([NO_ID if i is None else i for i in doc_ids], "<i8").tobytes()
    yield starts.tobytes()
    yield offsets.tobytes()
    yield payload


def _open(uri: str):
    store, path = fs.FileSystem.from_uri(uri)
    return store, path


class IdFile:
    """Random access to one file: documents by number, ids by range."""

    def __init__(self, uri: str):
        store, path = _open(uri)
        self.file = store.open_input_file(path)
        magic, self.width, self.block, self.n_ids, n_docs, blocks = struct.unpack(HEAD, self.file.read(struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token-id file")
        self.doc_ids = np.frombuffer(self.file.read(8 * n_docs), "<i8")
        self.starts = np.frombuffer(self.file.read(8 * (n_docs + 1)), "<u8").astype(np.int64)
        self.offsets = np.frombuffer(self.file.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self.payload = self.file.tell()

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to before ``stop``; only the blocks between are read."""
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // self.block, -(-stop // self.block)
        self.file.seek(self.payload + int(self.offsets[first]))
        packed = self.file.read(int(self.offsets[last] - self.offsets[first]))
        n = min(last * self.block, self.n_ids) - first * self.block
        own = unpack(packed, n, self.width)
        return own[start - first * self.block : stop - first * self.block]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))

    def close(self) -> None:
        self.file.close()


def write_ids(
    docs: DataFrame,
    folder: str | None = None,
    vocabulary: str | None = None,
    end_id: int = 0,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the id files of all documents; returns the committed manifest."""
    folder = folder or scratch_path(docs.sparkSession, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary, end_id)
        width = width_of(coder.tokenizer.get_vocab_size())
        part, attempt, number = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0
        doc_ids, texts, size = [], [], 0

        def flushed() -> pa.RecordBatch:
            uri = f"{folder}/part-{part:07d}-{attempt}-{number}.ids"
            store, path = _open(uri)
            store.create_dir(path.rpartition("/")[0], recursive=True)
            with store.open_output_stream(path) as out:
                for piece in file_bytes(doc_ids, texts, width):
                    out.write(piece)
            row = [[part], [number], [uri], [len(doc_ids)], [size]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            return pa.record_batch(
                [pa.array(v, k) for v, k in zip(row, kinds)], ["part", "number", "file", "n_docs", "n_ids"]
            )

        for batch in slices(batches, 500):
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist())):
                doc_ids.append(doc_id)
                texts.append(ids)
                size += len(ids)
                if size >= file_ids:
                    yield flushed()
                    doc_ids, texts, size, number = [], [], 0, number + 1
        if doc_ids:
            yield flushed()

    ordered = (
        docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )
    manifest, _ = kept(ordered.mapInArrow(run, MANIFEST), "id-manifest")
    return manifest


def read_ids(manifest: DataFrame, most_tasks: int = 10_000) -> DataFrame:
    """``(doc_id, start, ids)`` of every document, from the files.

    ``start`` counts the ids of all documents before; ``ids`` are little-endian unsigned 32-bit
    integers as bytes.
    """
    placed = block_offsets(manifest, ["part", "number"], "n_ids", "before")
    files = max(1, min(manifest.count(), most_tasks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = IdFile(row["file"])
                n, at = len(file.doc_ids), 0
                while at < n:
                    # About a million ids at a time, and one document at least.
                    upto = int(np.searchsorted(file.starts, file.starts[at] + (1 << 20)))
                    upto = max(at + 1, min(upto, n))
                    edges = file.starts[at : upto + 1]
                    ids = file.ids(int(edges[0]), int(edges[-1])).astype("<u4").tobytes()
                    offsets = ((edges - edges[0]) * 4).astype(np.int32)
                    own = file.doc_ids[at:upto]
                    yield pa.record_batch(
                        [
                            pa.array(own, mask=own == NO_ID),
                            pa.array(edges[:-1] + row["before"]),
                            pa.Array.from_buffers(
                                pa.binary(), upto - at, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
                            ),
                        ],
                        ["doc_id", "start", "ids"],
                    )
                    at = upto
                file.close()

    return placed.select("file", "before").repartition(files).mapInArrow(
        run, "doc_id long, start long, ids binary"
    )
