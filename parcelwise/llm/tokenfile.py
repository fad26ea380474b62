"""Token ids in files of independent zstandard frames with a seek table and a checksum of every frame.

Layout of a file, all numbers little-endian: the data frames; a skippable frame with the zstd-compressed document
index (id present, id, number of token ids, frame); a skippable frame with the seek table in the layout of the public
zstd seekable format (for every data frame its compressed size, its decompressed size and the low 32 bits of the XXH64
of its content, then the number of frames, a flag byte and the closing magic number); one newline, which Spark's text
writer adds. A data frame holds the ids of whole documents as unsigned 32-bit integers. A reader needs the end of a
file, then only the frames of the documents it wants.

Files are written by Spark's own writer, which commits tasks: a lost executor's half-written files never show, and any
file system that Spark can write to will do. Documents are dealt to files by ranges of their id.

Defined results: a null or empty text holds only the end id; null ids come first; rows that repeat an id stay, ordered
by text; an empty table gives no documents; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import blocks, starts
from parcelwise.llm.tokenize import encode_texts, vocabulary_path

#: Fixed values of the public formats: skippable frames and the end of a seek table.
SKIP_INDEX, SKIP_SEEK, SEEK_END = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
#: Token ids that a data frame holds before it is closed.
FRAME_IDS = 1 << 18
_INDEX = np.dtype([("known", "u1"), ("id", "<i8"), ("n", "<u4"), ("frame", "<u4")])


#: Bytes of ids that one file is meant to hold.
FILE_BYTES = 128 << 20


class Writer:
    """Collects documents, compresses a frame as soon as it is full, and gives the file at the end."""

    def __init__(self, frame_ids: int = FRAME_IDS, level: int = 3):
        self.frame_ids, self.packer = frame_ids, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames, self.table, self.index, self.open, self.held = [], [], [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.index.append((doc_id is not None, doc_id or 0, len(ids), len(self.frames)))
        self.open.append(ids.astype("<u4").tobytes())
        self.held += len(ids)
        if self.held >= self.frame_ids:
            self.close_frame()

    def close_frame(self) -> None:
        import xxhash

        if self.open:
            content = b"".join(self.open)
            packed = self.packer.compress(content)
            self.frames.append(packed)
            self.table.append(struct.pack("<III", len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
            self.open, self.held = [], 0

    def finish(self) -> bytes:
        self.close_frame()
        index = self.packer.compress(np.array(self.index, _INDEX).tobytes())
        table = b"".join(self.table) + struct.pack("<IBI", len(self.table), 0x80, SEEK_END)
        return b"".join([*self.frames, struct.pack("<II", SKIP_INDEX, len(index)), index, struct.pack("<II", SKIP_SEEK, len(table)), table])


class Reader:
    """Reads documents from a seekable binary file object; ``bytes_read`` counts what it took from it."""

    def __init__(self, source):
        import io

        self.source, self.bytes_read = source, 0
        end = source.seek(0, io.SEEK_END)
        tail = self.take(max(0, end - 10), min(10, end))
        end -= tail[-1:] == b"\n" and tail[-5:-1] == struct.pack("<I", SEEK_END)
        n, _, magic = struct.unpack("<IBI", self.take(end - 9, 9))
        if magic != SEEK_END:
            raise ValueError("not a token file: it has no seek table")
        at = end - 9 - 12 * n
        self.table = np.frombuffer(self.take(at, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.frame_at = starts(self.table[:, 0])
        head = int(self.frame_at[-1])
        magic, size = struct.unpack("<II", self.take(head, 8))
        if magic != SKIP_INDEX:
            raise ValueError("not a token file: it has no document index")
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.take(head + 8, size)), _INDEX)
        self.doc_at = starts(self.index["n"].astype(np.int64))
        self.first_in = starts(np.bincount(self.index["frame"], weights=self.index["n"], minlength=n).astype(np.int64))

    def take(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        self.bytes_read += size
        return self.source.read(size)

    def frame(self, k: int) -> np.ndarray:
        """The ids of frame ``k``, after its checksum has been compared."""
        import xxhash

        packed, size, check = (int(x) for x in self.table[k])
        content = zstandard.ZstdDecompressor().decompress(self.take(int(self.frame_at[k]), packed), max_output_size=size)
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check or len(content) != size:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(content, "<u4")

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in their order, one frame in memory at a time."""
        now, ids = -1, None
        for row, at in zip(self.index, self.doc_at, strict=False):
            if row["frame"] != now:
                now = int(row["frame"])
                ids = self.frame(now)
            low = int(at - self.first_in[now])
            yield (int(row["id"]) if row["known"] else None), ids[low : low + int(row["n"])]

    def get(self, doc_ids: Iterable[int]) -> dict[int, np.ndarray]:
        """Some documents; only the frames that hold them are read and decompressed."""
        wanted = np.flatnonzero(np.isin(self.index["id"], np.fromiter(doc_ids, np.int64)) & (self.index["known"] == 1))
        out: dict[int, np.ndarray] = {}
        for k in np.unique(self.index["frame"][wanted]):
            ids = self.frame(int(k))
            for i in wanted[self.index["frame"][wanted] == k]:
                low = int(self.doc_at[i] - self.first_in[k])
                out[int(self.index["id"][i])] = ids[low : low + int(self.index["n"][i])]
        return out


def write_token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json", end_id: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Encodes all documents, ``end_id`` after each, into files under ``path`` in ascending order of the id (and of a
    hash of the text, so that rows of one id may go to several files). A file holds about ``file_bytes`` of ids."""
    vocabulary = vocabulary_path(vocabulary)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, size = Writer(), 0
        for block in blocks(batches, "text", 8 << 20):
            ids, counts = encode_texts(vocabulary, block.column("text"))
            at = starts(counts)
            for i, doc_id in enumerate(block.column("id").to_pylist()):
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([writer.finish()], pa.binary())], ["file"])
                    writer, size = Writer(), 0
                writer.add(doc_id, np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)))
                size += 4 * int(counts[i] + 1)
        if writer.index:
            yield pa.RecordBatch.from_arrays([pa.array([writer.finish()], pa.binary())], ["file"])

    dealt = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    dealt = dealt.withColumn("tie", F.xxhash64("text"))
    dealt = dealt.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").drop("tie")
    files = dealt.mapInArrow(pack, "file binary").select(F.col("file").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).text(path)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in the files, from the ids as they were read.

    ``start`` counts the ids of all documents before it, over all files in the order of the two numbers in their names
    (the task's, and the file's within the task).
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                if content.as_py() is None or len(content.as_py()) < 10:
                    continue
                reader = Reader(io.BytesIO(content.as_buffer()))
                rows = [(doc_id, len(ids), zlib.crc32(ids.tobytes())) for doc_id, ids in reader.documents()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows)), pa.array([r[0] for r in rows], pa.int64()), pa.array(reader.doc_at[:-1]), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                    ["name", "id", "at", "n_tokens", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    rows = files.mapInArrow(read, "name string, id long, at long, n_tokens long, ids_crc32 long")
    number = lambda pattern: F.regexp_extract("name", pattern, 1).cast("long")
    before = Window.orderBy(number(r"^part-(\d+)"), number(r"-c(\d+)\."), "name").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("name").agg(F.sum("n_tokens").alias("file_tokens"))
    totals = totals.select("name", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("base"))
    return rows.join(totals, "name").select(F.col("id").alias(id_col), (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
