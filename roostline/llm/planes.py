"""Token ids in files of byte or bit planes.

One file per range of doc_ids:

    magic | planes of chunk 0 | planes of chunk 1 | ... | document table | chunk index | footer

A chunk is a block of ``BLOCK`` ids (the last one may be shorter), transposed so that plane k
holds byte k (or bit k) of all its ids; each plane is compressed with zstandard, and an empty
plane, all zeros, takes no bytes. The document table has the doc_id and the number of ids of
each document; the chunk index has the place of each chunk, its number of ids and the sizes
of its planes, so that any range of ids is read without the rest.

A task writes under a name of its own and only files that the finished job lists count, so a
repeated task leaves at most a file that nobody reads.

Defined cases: a null or empty text has only the end id; repeated rows are written as often as
they occur, one after the other; rows of one doc_id with different texts are ordered by the
hashes of those; a doc_id of very many rows is spread over files; rows without a doc_id come first; an empty table gives no
rows; a long text spans chunks; columns other than id and text are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roostline.llm.common import bounded_batches, table, texts, written
from roostline.session import scratch_dir

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
END_ID = 2
RESULT_ROWS = 1 << 14
FOOTER = struct.Struct("<QIIIB7x8s")  # document table, its bytes, chunks, documents, planes
NULL_ID = -(1 << 63)


def split_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of unsigned 32-bit ids."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def join_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        raw = np.zeros((n, 4), np.uint8)
        for k, plane in enumerate(planes):
            if plane:
                raw[:, k] = np.frombuffer(plane, np.uint8)
        return raw.view("<u4").ravel()
    bits = np.zeros((n, 32), np.uint8)
    for k, plane in enumerate(planes):
        if plane:
            bits[:, k] = np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little")
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


class PlaneWriter:
    """Writes one file; holds one block of ids and the document table."""

    def __init__(self, stream, planes: int = 4, block: int = BLOCK):
        self.stream, self.planes, self.block = stream, planes, block
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.at = stream.write(MAGIC) and len(MAGIC)
        self.waiting: list[bytes] = []
        self.waiting_bytes = 0
        self.docs: list[tuple[int, int]] = []
        self.index: list[tuple[int, ...]] = []
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((NULL_ID if doc_id is None else doc_id, len(ids) // 4))
        self.n_ids += len(ids) // 4
        self.waiting.append(ids)
        self.waiting_bytes += len(ids)
        if self.waiting_bytes >= 4 * self.block:
            ready = b"".join(self.waiting)
            whole = len(ready) - len(ready) % (4 * self.block)
            for start in range(0, whole, 4 * self.block):
                self._chunk(ready[start : start + 4 * self.block])
            self.waiting, self.waiting_bytes = [ready[whole:]], len(ready) - whole

    def _chunk(self, raw: bytes) -> None:
        ids = np.frombuffer(raw, "<u4")
        sizes = []
        start = self.at
        for plane in split_planes(ids, self.planes):
            packed = self.zstd.compress(plane) if plane.strip(b"\0") else b""
            self.stream.write(packed)
            self.at += len(packed)
            sizes.append(len(packed))
        self.index.append((start, len(ids), *sizes))

    def close(self) -> None:
        if self.waiting_bytes:
            self._chunk(b"".join(self.waiting))
        ids = np.array([d for d, _ in self.docs], "<i8").tobytes()
        counts = np.array([n for _, n in self.docs], "<u8").tobytes()
        docs = self.zstd.compress(ids + counts)
        self.stream.write(docs)
        self.stream.write(np.array(self.index, "<u8").tobytes())
        self.stream.write(
            FOOTER.pack(self.at, len(docs), len(self.index), len(self.docs), self.planes, MAGIC)
        )


class PlaneReader:
    """Reads one file; holds one chunk and the document table."""

    def __init__(self, stream, size: int):
        self.stream = stream
        self.zstd = zstandard.ZstdDecompressor()
        stream.seek(size - FOOTER.size)
        at, n_bytes, chunks, docs, self.planes, magic = FOOTER.unpack(stream.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a file of id planes")
        stream.seek(at)
        raw = self.zstd.decompress(stream.read(n_bytes), max_output_size=16 * docs + 1)
        self.doc_ids = np.frombuffer(raw[: 8 * docs], "<i8")
        self.counts = np.frombuffer(raw[8 * docs :], "<u8").astype(np.int64)
        self.index = np.frombuffer(
            stream.read(8 * chunks * (2 + self.planes)), "<u8"
        ).reshape(chunks, 2 + self.planes)
        self.ends = np.cumsum(self.index[:, 1].astype(np.int64))

    def chunk(self, k: int) -> np.ndarray:
        start, n, *sizes = (int(x) for x in self.index[k])
        self.stream.seek(start)
        planes = [self.zstd.decompress(self.stream.read(s)) if s else b"" for s in sizes]
        return join_planes(planes, n)

    def ids(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` to ``stop`` of this file, through the chunks that hold them."""
        k = int(np.searchsorted(self.ends, start, "right"))
        while start < stop:
            first = int(self.ends[k] - self.index[k, 1])
            yield self.chunk(k)[start - first : stop - first]
            start, k = int(self.ends[k]), k + 1

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """Every document: its id, its number of ids, and its ids in parts."""
        k, chunk, used = -1, np.zeros(0, np.uint32), 0
        for doc_id, n in zip(self.doc_ids.tolist(), self.counts.tolist()):
            parts, missing = [], n
            while missing:
                if used == len(chunk):
                    k, used = k + 1, 0
                    chunk = self.chunk(k)
                part = chunk[used : used + missing]
                parts.append(part)
                used += len(part)
                missing -= len(part)
            yield None if doc_id == NULL_ID else doc_id, n, iter(parts)


def write_planes(
    docs: DataFrame, folder: str, vocabulary: str, lower: bool, end_id: int, planes: int = 4
) -> DataFrame:
    """Encode ``docs`` and write them in ascending doc_id order. Returns the list of files:
    shard (in doc_id order), path, bytes, documents and ids."""
    spark = docs.sparkSession
    bounded_batches(spark)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        from roostline.llm.tokens import encoder

        shard = TaskContext.get().partitionId()
        writer = stream = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                files, base = FileSystem.from_uri(folder)
                files.create_dir(base, recursive=True)
                path = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex}.planes"
                stream = files.open_output_stream(path)
                writer = PlaneWriter(stream, planes)
            doc_ids = batch.column("doc_id").to_pylist()
            encoded = encoder(vocabulary, lower).encode(batch.column("text").to_pylist())
            for doc_id, ids in zip(doc_ids, encoded):
                writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            stream.close()
            size = files.get_file_info(path).size
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "path": [path],
                    "size": pa.array([size], pa.int64()),
                    "n_docs": pa.array([len(writer.docs)], pa.int64()),
                    "n_ids": pa.array([writer.n_ids], pa.int64()),
                }
            )

    source = texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows of one doc_id are ordered by their texts' hashes. Those of one text are alike, so
    # where each stands does not matter: numbering them lets a range end between them.
    order = ["doc_id", "hash", "number"]
    numbered = source.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("number"))
    ordered = numbered.repartitionByRange(count, *order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = "shard int, path string, size bigint, n_docs bigint, n_ids bigint"
    return written(ordered.mapInArrow(write, schema), "plane-files")


def read_planes(files: DataFrame, folder: str) -> DataFrame:
    """Per document of the listed files: doc_id, start, n_tokens and the crc32 of its ids.

    The start of a file is the running sum over the list of files, one short row per file.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        def result(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

        source, _ = FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                with source.open_input_file(row["path"]) as stream:
                    start = row["first"]
                    for doc_id, n, parts in PlaneReader(stream, row["size"]).documents():
                        crc = 0
                        for part in parts:
                            crc = zlib.crc32(part.tobytes(), crc)
                        rows.append((doc_id, start, n, crc))
                        start += n
                        if len(rows) == RESULT_ROWS:
                            yield result(rows)
                            rows = []
                if rows:
                    yield result(rows)

    count = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.select("path", "size", "first", "shard").repartition(count, "shard")
    return dealt.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op5_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_dir(spark, "id-planes")
    path = public_tokenizers.path("word_bpe_49k.json")
    files = write_planes(table(spark, sf_dir, "documents"), folder, path, True, END_ID)
    return read_planes(files, folder)
