"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A file is a run of zstandard frames, each holding the documents of about ``FRAME_BYTES`` of ids, and one skippable
frame at the end that lists them. All numbers are little-endian.

    frame       zstandard (content checksum on) over: u32 n, n x i64 doc_id, n x u32 n_tokens, ids as u32
    seek table  u32 0x184D2A5E, u32 size, then per frame
                u64 offset, u32 compressed size, u32 CRC-32 of the compressed bytes, u32 documents, u64 ids, i64 first and last doc_id;
                u32 number of frames, u8 0, u32 0x8F92EAB1

A plain zstandard reader skips the table; ``read_frames`` reads it from the end and then only the frames asked for.

``write`` sorts by doc_id in ranges, one file per range, and names each file after the range and the attempt; the
table of committed names is what readers follow, so a lost executor or a second attempt leaves no doubled rows. Files
go through Arrow's file systems, to any folder that all executors reach.

Defined results: a null or empty text is the end id alone; rows with equal ids stay apart, in order of their text; null
ids come first and are written as the smallest number; an empty table gives no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.tokens import default_vocabulary, encode_documents, slices

FRAME_BYTES = 1 << 20
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_ENTRY = struct.Struct("<QIIIQqq")
_NO_ID = -(1 << 63)
_TEXT_PART = 1 << 20

FILES = "path string, part int, n_docs bigint, n_ids bigint, n_frames int, n_bytes bigint"
DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class FrameWriter:
    """Appends documents to an open binary file; ``close`` writes the seek table."""

    def __init__(self, sink):
        import zstandard

        self.sink, self.packer = sink, zstandard.ZstdCompressor(level=1, write_checksum=True)
        self.entries, self.at, self.pending, self.size = [], 0, [], 0
        self.n_docs = self.n_ids = 0

    def add(self, doc_id: int, ids: bytes) -> None:
        self.pending.append((doc_id, ids))
        self.size += len(ids)
        if self.size >= FRAME_BYTES:
            self._flush()

    def _flush(self) -> None:
        if not self.pending:
            return
        ids = np.array([d for d, _ in self.pending], "<i8")
        counts = np.array([len(x) // 4 for _, x in self.pending], "<u4")
        frame = self.packer.compress(b"".join([struct.pack("<I", len(ids)), ids.tobytes(), counts.tobytes(), *[x for _, x in self.pending]]))
        self.sink.write(frame)
        n = int(counts.sum(dtype=np.int64))
        self.entries.append((self.at, len(frame), zlib.crc32(frame), len(ids), n, int(ids[0]), int(ids[-1])))
        self.at += len(frame)
        self.n_docs, self.n_ids = self.n_docs + len(ids), self.n_ids + n
        self.pending, self.size = [], 0

    def close(self) -> None:
        self._flush()
        body = b"".join(_ENTRY.pack(*e) for e in self.entries) + struct.pack("<IBI", len(self.entries), 0, _SEEKABLE)
        self.sink.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)
        self.at += 8 + len(body)


def seek_table(source, size: int) -> list[tuple]:
    """Entries (offset, size, crc32, documents, ids, first id, last id) of an open file."""
    source.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != _SEEKABLE:
        raise ValueError("no seek table at the end of the file")
    body = n * _ENTRY.size
    source.seek(size - 9 - body - 8)
    head = struct.unpack("<II", source.read(8))
    if head != (_SKIPPABLE, body + 9):
        raise ValueError("damaged seek table")
    return list(_ENTRY.iter_unpack(source.read(body)))


def read_frames(path: str, wanted: set[int] | None = None) -> Iterator[tuple[int, bytes]]:
    """(doc_id, ids) in file order; with ``wanted``, only frames whose id range meets it are read."""
    import zstandard

    system, inner = _file_system(path)
    with system.open_input_file(inner) as source:
        for offset, size, crc, _, _, first, last in seek_table(source, source.size()):
            if wanted is not None and not any(first <= w <= last for w in wanted):
                continue
            source.seek(offset)
            frame = source.read(size)
            if zlib.crc32(frame) != crc:
                raise ValueError(f"damaged frame at {offset} of {path}")
            raw = zstandard.ZstdDecompressor().decompress(frame)
            (n,) = struct.unpack_from("<I", raw)
            ids, counts = np.frombuffer(raw, "<i8", n, 4), np.frombuffer(raw, "<u4", n, 4 + 8 * n)
            at = 4 + 12 * n
            for doc_id, count in zip(ids.tolist(), counts.tolist()):
                if wanted is None or doc_id in wanted:
                    yield doc_id, raw[at:at + 4 * count]
                at += 4 * count


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
          partitions: int | None = None) -> DataFrame:
    """Write one file per doc_id range below ``folder``; returns the table of files in order (``FILES``)."""
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"))
    keys = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    ordered = ranged.withColumn("part", F.spark_partition_id()).sortWithinPartitions(keys[0], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = system = None
        part = -1
        for batch in batches:
            ids, texts, parts = (batch.column(i).to_pylist() for i in range(3))
            if not ids:
                continue
            if writer is None:
                part = parts[0]
                system, inner = _file_system(folder)
                system.create_dir(inner, recursive=True)
                path = f"{inner.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}.zst"
                stream = system.open_output_stream(path, compression=None)
                writer = FrameWriter(stream)
            for begin, end in slices([len(t or "") for t in texts], _TEXT_PART):
                for doc_id, encoded in zip(ids[begin:end], encode_documents(texts[begin:end], vocabulary)):
                    writer.add(_NO_ID if doc_id is None else doc_id, encoded)
        if writer is not None:
            writer.close()
            stream.close()
            name = f"{folder.rstrip('/')}/{path.rsplit('/', 1)[1]}"
            yield pa.RecordBatch.from_pydict({
                "path": pa.array([name]), "part": pa.array([part], pa.int32()), "n_docs": pa.array([writer.n_docs], pa.int64()),
                "n_ids": pa.array([writer.n_ids], pa.int64()), "n_frames": pa.array([len(writer.entries)], pa.int32()),
                "n_bytes": pa.array([writer.at], pa.int64())})

    files = f"{folder.rstrip('/')}-files"
    ordered.mapInArrow(run, FILES).write.mode("overwrite").parquet(files)
    return docs.sparkSession.read.schema(FILES).parquet(files)


def read(files: DataFrame) -> DataFrame:
    """One row per document of these files: id, number of ids before it, its ids' number and CRC-32 (``DOCS``).

    The table of files is one small row per range: its running total is taken on the driver.
    """
    listed, total = [], 0
    for f in sorted(files.collect(), key=lambda f: f["part"]):
        listed.append((f["path"], total))
        total += f["n_ids"]
    spark = files.sparkSession
    if not listed:
        return spark.createDataFrame([], DOCS)
    table = spark.createDataFrame(listed, "path string, start bigint").repartition(len(listed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, at = [], start
                for doc_id, ids in read_frames(path):
                    rows.append((None if doc_id == _NO_ID else doc_id, at, len(ids) // 4, zlib.crc32(ids)))
                    at += len(ids) // 4
                    if len(rows) == 8192:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    return table.mapInArrow(run, DOCS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])
