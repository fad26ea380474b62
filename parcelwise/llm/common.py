"""Helpers that several operators of this subpackage share.

Texts reach Python as Arrow batches. They are worked on in *blocks* of bounded size, so that the memory of a task
does not depend on how many rows its partition has, and all per-word work is done by Arrow and numpy kernels.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.sources.store import scratch

#: Bytes of text that a block holds at most; a single longer text is a block of its own.
BLOCK_BYTES = 16 << 20

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
#: ASCII white space becomes a blank, A-Z becomes a-z: words are then what stands between blanks.
SPACED = bytes.maketrans(_UPPER + bytes(range(9, 14)), _LOWER + b" " * 5)
#: As above, and so does every ASCII character that is neither a digit nor a letter.
ALNUM = bytes.maketrans(
    _UPPER + bytes(b for b in range(128) if not chr(b).isalnum()), _LOWER + b" " * sum(not chr(b).isalnum() for b in range(128))
)


def frozen(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here and survives lost executors."""
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of the bit table of :func:`sifted`, 64 bits each, however many keys it is made of.
SIEVE_ROWS = 1 << 16


def sifted(rows: DataFrame, wanted: DataFrame, keys: dict[str, str], name: str) -> DataFrame:
    """Rows with a flag that is true if their keys may be among those of ``wanted`` (keys: column of rows to column of
    wanted) and false if they are not, by a bit table of at most SIEVE_ROWS rows, which is broadcast. It spares rows a
    shuffle; with very many keys all bits are set and none is spared."""
    hashed = lambda columns: F.xxhash64(F.lit(11), *[F.col(c) for c in columns])
    word, bit = (lambda h: F.pmod(h, F.lit(SIEVE_ROWS))), (lambda h: F.shiftrightunsigned(h, 58).cast("int"))
    h = hashed(keys.values())
    table = wanted.select(word(h).alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit(h)).alias("_bit"))
    table = table.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    rows = rows.withColumn("_hash", hashed(keys))
    rows = rows.join(F.broadcast(table), word(F.col("_hash")) == F.col("_word"), "left")
    return rows.withColumn(name, F.coalesce(F.getbit("_bits", bit(F.col("_hash"))) == 1, F.lit(False))).drop("_hash", "_word", "_bits")


def fold(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null ids: fold 0)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(0)).cast("int")


def strings(column: pa.Array) -> pa.LargeStringArray:
    """The texts with nulls as empty texts and offsets from zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pa.concat_arrays([pc.fill_null(column.cast(pa.large_string()), ""), pa.array([], pa.large_string())])


def sizes(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def give_back() -> None:
    """Returns memory that a finished block has left in the allocators, so that two workers fit beside an executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc: its allocator decides
        pass


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a partition regrouped into blocks of about ``limit`` bytes of ``column``."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(sizes(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit - size, side="right")))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1] - done)
            start = stop
            if size >= limit or start < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
                give_back()
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        del held
        give_back()


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of a partition one at a time, for rows that are large themselves."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
            give_back()


def translated(texts: pa.LargeStringArray, table: bytes) -> pa.LargeStringArray:
    """Every byte mapped by ``table``, which may only change ASCII to ASCII."""
    _, offsets, data = texts.buffers()
    mapped = data.to_pybytes().translate(table) if data is not None else b""
    return pa.LargeStringArray.from_buffers(len(texts), offsets, pa.py_buffer(mapped), None, 0, texts.offset)


def words(texts: pa.LargeStringArray, table: bytes = SPACED) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of all texts as codes, the number of words of each text, and the distinct words by code."""
    lists = pc.split_pattern(translated(texts, table), " ")
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    counts = np.diff(lists.offsets.to_numpy().astype(np.int64))
    blank = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if blank >= 0:
        real = codes != blank
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[real], minlength=len(counts))
        codes = codes[real]
    return codes, counts.astype(np.int64), coded.dictionary


def hashes(distinct: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct words."""
    import xxhash

    one = xxhash.xxh3_64_intdigest
    return np.fromiter((one(w) for w in distinct.cast(pa.large_binary()).to_pylist()), np.uint64, len(distinct))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def starts(counts: np.ndarray) -> np.ndarray:
    """Offsets of runs of the given lengths, with the total at the end."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def gathered(values: np.ndarray, offsets: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the runs ``picks`` of ``values``, and the lengths of those runs."""
    lengths = np.diff(offsets)[picks]
    out = starts(lengths)
    index = np.arange(out[-1]) + np.repeat(offsets[:-1][picks] - out[:-1], lengths)
    return values[index], lengths
