"""Token-id files: ids in blocks, each block transposed into bit or byte planes, each plane compressed.

A file holds whole documents in ascending id order:

    "SWKTOK1\\n"
    planes of block 0, planes of block 1, ...       (zstandard)
    document table: ids and token counts            (byte planes, zstandard)
    index: JSON with each block's place, plane sizes and number of ids  (zstandard)
    length of the index (8 bytes, little-endian), "SWKTOK1\\n"

A block holds the same number of ids (the last may hold fewer), so any range
of ids is found in the index and read without the rest.  Neighbouring ids have
like high bytes, which lie together in their plane and compress well.

Files go to a folder that all executors reach.  A task writes under a name of
its attempt and renames the file when it is whole, so that a lost executor
leaves no half file; the manifest lists the files that count.

Defined cases: null and empty texts have the end id alone; a null document id
comes first; documents of equal id are ordered by text; an empty table gives
no file; further columns are ignored.
"""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.llm.bpe import model_text
from seawake.llm.common import batch, shuffle_partitions, stored, strings
from seawake.llm.encoding import SharedEncoder

MAGIC = b"SWKTOK1\n"
BLOCK = 1 << 16
LEVEL = 3
NULL_ID = -(1 << 63)
#: Chunks in half of a worker's table: a task here holds little else, and words that leave the table are encoded again.
KEPT_CHUNKS = 700_000


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of unsigned integers, lowest first; planes above the highest bit in use are left out."""
    width = ids.dtype.itemsize
    octets = ids.astype(ids.dtype.newbyteorder("<")).view(np.uint8).reshape(-1, width)
    top = int(ids.max()).bit_length() if len(ids) else 0
    if not bits:
        return [np.ascontiguousarray(octets[:, i]).tobytes() for i in range(-(-top // 8))]
    rows = np.unpackbits(octets[:, : -(-top // 8)], axis=1, bitorder="little")
    return [np.packbits(rows[:, i], bitorder="little").tobytes() for i in range(top)]


def from_planes(planes: list[bytes], count: int, dtype: str, bits: bool) -> np.ndarray:
    out = np.zeros((count, np.dtype(dtype).itemsize), np.uint8)
    if not bits:
        for i, p in enumerate(planes):
            out[:, i] = np.frombuffer(p, np.uint8)
        return out.view(dtype).ravel()
    rows = np.zeros((count, -(-len(planes) // 8) * 8), np.uint8)
    for i, p in enumerate(planes):
        rows[:, i] = np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little")
    packed = np.packbits(rows, axis=1, bitorder="little")
    out[:, : packed.shape[1]] = packed
    return out.view(dtype).ravel()


class Writer:
    """Writes one file; holds one block of ids, and the table of its documents."""

    def __init__(self, file, block: int = BLOCK, bits: bool = False):
        self.file, self.block, self.bits = file, block, bits
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)
        self.held: list[bytes] = []
        self.held_size = 0
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.blocks: list[list] = []
        self.at = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.file.write(data)
        self.at += len(data)
        return len(data)

    def _planes(self, values: np.ndarray, bits: bool) -> list:
        """Write the planes; their place, count and sizes."""
        return [self.at, len(values), [self._put(self.zstd.compress(p)) for p in to_planes(values, bits)]]

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Append a document: its ids as little-endian unsigned 32-bit integers."""
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.held.append(ids)
        self.held_size += len(ids) // 4
        if self.held_size >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        whole = len(ids) if last else len(ids) // self.block * self.block
        for at in range(0, whole, self.block):
            self.blocks.append(self._planes(ids[at : min(at + self.block, whole)], self.bits))
        self.held, self.held_size = [ids[whole:].tobytes()], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        plain = np.array([NULL_ID if i is None else i for i in self.doc_ids], np.int64).view(np.uint64)
        tables = [self._planes(plain, False), self._planes(np.array(self.counts, np.uint32), False)]
        index = {"block": self.block, "bits": self.bits, "blocks": self.blocks, "documents": tables}
        size = self._put(self.zstd.compress(json.dumps(index).encode()))
        self._put(size.to_bytes(8, "little") + MAGIC)


class Reader:
    """Reads one file through its index; ``ids(start, stop)`` touches only the blocks it needs."""

    def __init__(self, file, size: int):
        self.file, self.zstd = file, zstandard.ZstdDecompressor()
        tail = self._get(size - 16, 16)
        if tail[8:] != MAGIC or self._get(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token file, or not whole")
        length = int.from_bytes(tail[:8], "little")
        index = json.loads(self.zstd.decompress(self._get(size - 16 - length, length)))
        self.block, self.bits, self.blocks = index["block"], index["bits"], index["blocks"]
        doc_ids, counts = index["documents"]
        self.doc_ids = self._planes(doc_ids, "<u8", False).view(np.int64)
        self.counts = self._planes(counts, "<u4", False).astype(np.int64)
        self.cached: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _get(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def _planes(self, entry: list, dtype: str, bits: bool) -> np.ndarray:
        at, count, sizes = entry
        planes = []
        for size in sizes:
            planes.append(self.zstd.decompress(self._get(at, size)))
            at += size
        return from_planes(planes, count, dtype, bits)

    def _block(self, i: int) -> np.ndarray:
        if self.cached[0] != i:
            self.cached = (i, self._planes(self.blocks[i], "<u4", self.bits))
        return self.cached[1]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids of the file from ``start`` up to ``stop``."""
        parts = [
            self._block(i)[max(0, start - i * self.block) : stop - i * self.block]
            for i in range(start // self.block, -(-stop // self.block))
        ]
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, place of the first token in the file, and ids of each document in order."""
        at = 0
        for doc_id, count in zip(self.doc_ids.tolist(), self.counts.tolist(), strict=True):
            yield None if doc_id == NULL_ID else doc_id, at, self.ids(at, at + count)
            at += count


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    bits: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """Encode every document, append ``end_id`` and write files below ``folder``.

    Returns the stored manifest: ``part`` (order of the files), path, documents, tokens.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(SharedEncoder(model_text(tokenizer), "kept", KEPT_CHUNKS))
    schema = pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model.value.encoder
        store, root = pafs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        part = context.partitionId()
        draft, final = f"{root}/.part-{part:06d}-{uuid.uuid4().hex}", f"{root}/part-{part:06d}.tok"
        out = writer = None
        for b in batches:
            if writer is None and len(b):
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(draft, compression=None)
                writer = Writer(out, block, bits)
            for at in range(0, len(b), 512):
                some = b.slice(at, 512)
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder(strings(some.column(1))), strict=True):
                    writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            out.close()
            store.move(draft, final)
            yield batch(schema, [part], [final], [len(writer.counts)], [sum(writer.counts)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.repartitionByRange(shuffle_partitions(spark), "id").sortWithinPartitions("id", "text")
    return stored(dealt.mapInArrow(write, "part int, path string, documents long, tokens long"), "token-manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Documents of the files: doc_id, start (tokens before it in all files), ids (binary).

    The manifest has one row for each file; its running sum is made on the driver.
    """
    files, at = [], 0
    for row in manifest.orderBy("part").toLocalIterator():
        files.append((row["path"], at))
        at += row["tokens"]
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for path, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_input_file(path) as file:
                    rows: list[tuple] = []
                    size = 0
                    for doc_id, start, ids in Reader(file, file.size()).documents():
                        rows.append((doc_id, before + start, ids.tobytes()))
                        size += len(ids)
                        if size > 1 << 20:
                            yield batch(schema, *zip(*rows, strict=True))
                            rows, size = [], 0
                    if rows:
                        yield batch(schema, *zip(*rows, strict=True))

    table = spark.createDataFrame(files, "path string, before long").repartition(max(1, min(len(files), 10 * shuffle_partitions(spark))))
    return table.mapInArrow(read, "doc_id long, start long, ids binary")


def in_memory(documents: list[tuple[int | None, bytes]], block: int = BLOCK, bits: bool = False) -> Reader:
    """A file written and opened in memory."""
    out = io.BytesIO()
    writer = Writer(out, block, bits)
    for doc_id, ids in documents:
        writer.add(doc_id, ids)
    writer.close()
    return Reader(out, out.tell())
