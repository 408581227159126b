"""Token-id files: ids in blocks of fixed size, transposed to bit planes, each plane zstd-compressed.

A file holds the ids of consecutive documents. Layout, all numbers little-endian:

* ``CIDS1\\0\\0\\0`` (8 bytes);
* chunks, one per block of ids (the last may be shorter): a uint32 with the number of ids, one byte
  with the number of planes, a uint32 length per plane, then the planes. Plane p packs bit p of every id, the
  first id in the lowest bit, compressed by zstd; planes above the highest set bit of the block are absent;
* the document table, zstd-compressed: int64 triples (doc_id, first id in the file, number of ids);
* the chunk index, zstd-compressed: uint64 file offsets of the chunks;
* the tail of 56 bytes, uint64 each: documents, chunks, ids of the file, the packed lengths of the document table
  and of the chunk index, the ids of a whole block; then the magic again.

A reader finds the chunks of any document from the tail and the index alone.

Documents are ordered by doc_id over all files: rows are dealt by ranges of doc_id, each task writes one file,
and the ids before a file are running sums over one row per file.

Contract: one row per input row; a null text is an empty one (its only id is the end id); a null doc_id sorts
first; rows with equal doc_id follow each other, shorter first and then by their bytes. An empty table
writes nothing and gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civiclake.llm.bpe import Bpe, vocabulary
from civiclake.llm.common import blocks, shared_dir, small_batches, table
from civiclake.llm.files import Writer, make_folder, open_file
from civiclake.llm.pieces import Memo, pieces

MAGIC = b"CIDS1\0\0\0"
#: Ids of a block.
BLOCK = 1 << 16
_TAIL = struct.Struct("<6Q8s")
#: Stands for a null doc_id in the document table.
NO_ID = -(1 << 63)


def pack_block(ids: np.ndarray) -> bytes:
    """One chunk: the bit planes of a block of ids."""
    ids = np.ascontiguousarray(ids, "<u4")
    planes = int(ids.max()).bit_length() if len(ids) else 0
    raw = ids.view(np.uint8).reshape(-1, 4)
    packer = zstandard.ZstdCompressor(level=1)
    packed = [packer.compress(np.packbits((raw[:, p >> 3] >> (p & 7)) & 1, bitorder="little").tobytes()) for p in range(planes)]
    return struct.pack(f"<IB{planes}I", len(ids), planes, *map(len, packed)) + b"".join(packed)


def unpack_block(chunk: bytes) -> np.ndarray:
    """The ids of a chunk."""
    n, planes = struct.unpack_from("<IB", chunk)
    sizes = struct.unpack_from(f"<{planes}I", chunk, 5)
    at, out, reader = 5 + 4 * planes, np.zeros((n, 4), np.uint8), zstandard.ZstdDecompressor()
    for p, size in enumerate(sizes):
        bits = np.unpackbits(np.frombuffer(reader.decompress(chunk[at: at + size]), np.uint8), bitorder="little", count=n)
        out[:, p >> 3] |= bits << (p & 7)
        at += size
    return out.reshape(-1).view("<u4")


class FileWriter:
    """Appends documents to one file."""

    def __init__(self, folder: str, name: str, block: int = BLOCK):
        self.block = block
        self.out = Writer(folder, name)
        self.out.write(MAGIC)
        self.docs: list[tuple[int, int, int]] = []
        self.chunks: list[int] = []
        self.ids, self.held, self.waiting = 0, 0, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((NO_ID if doc_id is None else doc_id, self.ids, len(ids)))
        self.ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        whole = len(ids) if last else len(ids) - len(ids) % self.block
        for k in range(0, whole, self.block):
            self.chunks.append(self.out.size)
            self.out.write(pack_block(ids[k: min(k + self.block, whole)]))
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        packer = zstandard.ZstdCompressor(level=3)
        docs = packer.compress(np.array(self.docs, "<i8").tobytes())
        index = packer.compress(np.array(self.chunks, "<u8").tobytes())
        self.out.write(docs + index + _TAIL.pack(len(self.docs), len(self.chunks), self.ids, len(docs), len(index), self.block, MAGIC))
        self.out.close()


class FileReader:
    """Documents of a file, chunk by chunk."""

    def __init__(self, file):
        self.file, size = file, file.size()
        file.seek(size - _TAIL.size)
        n_docs, _, self.ids, docs, index, self.block, magic = _TAIL.unpack(file.read(_TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a token-id file, or a truncated one")
        file.seek(size - _TAIL.size - docs - index)
        packed = file.read(docs + index)
        reader = zstandard.ZstdDecompressor()
        self.docs = np.frombuffer(reader.decompress(packed[:docs]), "<i8").reshape(n_docs, 3)
        starts = np.frombuffer(reader.decompress(packed[docs:]), "<u8").astype(np.int64)
        self.chunks = np.append(starts, size - _TAIL.size - docs - index)

    def chunk(self, k: int) -> np.ndarray:
        self.file.seek(int(self.chunks[k]))
        return unpack_block(self.file.read(int(self.chunks[k + 1] - self.chunks[k])))

    def document(self, row: int) -> np.ndarray:
        """The ids of one document; only its chunks are read."""
        _, first, n = (int(x) for x in self.docs[row])
        if not n:
            return np.empty(0, np.uint32)
        low = first // self.block
        ids = np.concatenate([self.chunk(k) for k in range(low, (first + n - 1) // self.block + 1)])
        return ids[first - low * self.block: first - low * self.block + n]

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order; every chunk is read once."""
        ids, base, k = np.empty(0, np.uint32), 0, 0
        for doc_id, first, n in self.docs.tolist():
            parts, have = [ids[first - base:]], base + len(ids)
            while have < first + n:
                parts.append(self.chunk(k))
                have += len(parts[-1])
                k += 1
            if len(parts) > 1:
                ids, base = np.concatenate(parts), first
            yield (None if doc_id == NO_ID else doc_id), ids[first - base: first - base + n]


@cache
def _worker(path: str) -> tuple[Bpe, Memo]:
    bpe = Bpe(path)
    return bpe, Memo(lambda piece: np.array(bpe.encode_piece(piece), "<u4").tobytes())


def write(docs: DataFrame, folder: str, path: str, end_id: int = 1, block: int = BLOCK) -> DataFrame:
    """Writes the ids of all documents (doc_id, text) into ``folder``; one row per file: path, part, ids."""
    small_batches(docs.sparkSession)
    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("size", F.length("text"))
    ordered = placed.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "size", F.col("text").cast("binary")).drop("size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = _worker(path)
        part, end, out = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes(), None
        name = f"part-{part:06d}.ids"
        for batch in blocks(batches):
            out = out or FileWriter(folder, name, block)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                out.add(doc_id, np.frombuffer(b"".join(map(known.__getitem__, pieces(text, bpe.special))) + end, "<u4"))
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "part": [part], "ids": [out.ids]})

    return ordered.mapInArrow(run, "path string, part long, ids long")


def with_starts(files: DataFrame) -> DataFrame:
    """Adds ``before``: the ids of all earlier files. A window over one row per file."""
    return files.withColumn("before", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def read(files: DataFrame, emit: str = "digests") -> DataFrame:
    """Documents of the files (path, before). ``emit="ids"``: doc_id, ids; ``"digests"``: doc_id, start, n_tokens, ids_crc32."""
    schema = "doc_id long, ids array<long>" if emit == "ids" else "doc_id long, start long, n_tokens long, ids_crc32 long"
    names = [x.split(" ")[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64())] if emit == "ids" else [pa.int64()] * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as file:
                    rows, start, held = [], row["before"], 0
                    for doc_id, ids in FileReader(file):
                        rows.append((doc_id, ids.tolist()) if emit == "ids" else (doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        held += len(ids) if emit == "ids" else 1
                        if held > 100_000:
                            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)

    # One task per file: the count keeps Spark from joining these short rows into one task.
    return files.select("path", "before").repartition(max(1, files.count()), "path").mapInArrow(run, schema)


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token ids and read back."""
    folder = shared_dir(spark, "ids")
    make_folder(folder)
    write(table(spark, sf_dir, "documents"), folder, vocabulary()).write.parquet(f"{folder}-index")
    files = spark.read.schema("path string, part long, ids long").parquet(f"{folder}-index")
    return read(with_starts(files))
