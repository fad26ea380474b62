"""BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash over the bytes of every text marks chunk ends, so equal passages fall into equal chunks wherever they
stand. Every distinct chunk of a block is encoded once, however many documents hold it: its inner part, between the
first and the last place where the tokenizer is bound to cut. At each join of two chunks the text between those places
is encoded again, also inside a window with the neighbouring pieces, whose ids must agree exactly with those of its
parts; where they do not, the window grows to the whole text. No shuffle is needed: chunks are shared within a block, and a block is as much
text as a task can hold. (Sharing over the whole corpus would shuffle all distinct chunks and all their ids, twice the
size of the text, to save encodings that cost less than that.)

Defined results: a null or empty text has no ids; repeated rows stay; an empty table gives an empty table; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import blocks, gathered, starts, strings
from parcelwise.llm.tokenize import cuts, encode_each, encode_pieces, load, vocabulary_path

#: The rolling hash spans 2**WINDOW_BITS bytes; a chunk ends where its lowest CHUNK_BITS bits are zero.
WINDOW_BITS, CHUNK_BITS = 4, 9

#: Bytes of text in one block.
BLOCK = 8 << 20


def chunk_ends(data: np.ndarray, offsets: np.ndarray, bits: int = CHUNK_BITS) -> np.ndarray:
    """Starts of all chunks and the end of the last. Chunks never span two texts nor part a character.

    The hash of a window is built by doubling: twice the span from two neighbouring spans.
    """
    table = (np.arange(256, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
    rolled, span, factor = table[data], 1, np.uint32(0x01000193)
    for _ in range(WINDOW_BITS):
        doubled = rolled.copy()
        doubled[span:] += rolled[:-span] * factor
        rolled, span, factor = doubled, span * 2, np.uint32(int(factor) * int(factor) & 0xFFFFFFFF)
    mark = np.zeros(len(data) + 1, bool)
    mark[1:] = (rolled >> np.uint32(32 - bits)) == 0
    mark[:-1] &= (data & 0xC0) != 0x80
    mark[offsets] = True
    return np.flatnonzero(mark)


def encode_with_chunks(path: str, column: pa.Array, bits: int = CHUNK_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts end to end and how many each has, equal to encoding each text by itself."""
    texts = strings(column)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    ends = chunk_ends(data, offsets, bits)
    chunks = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode()
    use = chunks.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    per_text = np.diff(np.searchsorted(ends, offsets))
    # Every distinct chunk is taken apart once: head piece, inner pieces, tail piece.
    distinct = strings(chunks.dictionary)
    chunk_at = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1]
    chunk_data = np.frombuffer(distinct.buffers()[2], np.uint8)[: chunk_at[-1]]
    piece_at = cuts(chunk_data, chunk_at)
    first = np.searchsorted(piece_at, chunk_at)
    coded = pa.LargeStringArray.from_buffers(len(piece_at) - 1, pa.py_buffer(piece_at.astype(np.int64)), pa.py_buffer(chunk_data)).dictionary_encode()
    piece = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_pieces = np.diff(first)
    inner = np.ones(len(piece), bool)
    inner[first[:-1]] = False
    inner[first[1:] - 1] = False
    known = coded.dictionary.to_pylist()
    used = np.flatnonzero(np.bincount(piece[inner], minlength=len(known)))
    ids, n = encode_pieces(path, [known[k] for k in used])
    slot = np.zeros(len(known), np.int64)
    slot[used] = np.arange(len(used))
    at = starts(n)
    chunk_ids, lengths = gathered(ids, at, slot[piece[inner]])
    inner_owner = np.repeat(np.arange(len(distinct)), n_pieces)[inner]
    chunk_n = np.bincount(inner_owner, weights=lengths, minlength=len(distinct)).astype(np.int64)
    # Joins: one before each chunk and one at each text's end. A chunk of one piece leaves its join open.
    joins, join_of = {}, []
    heads, tails, single = piece[first[:-1]], piece[first[1:] - 1], n_pieces == 1
    second, before_tail = piece[np.minimum(first[:-1] + 1, first[1:] - 1)], piece[np.maximum(first[1:] - 2, first[:-1])]
    position = 0
    use_list, heads, tails, single = use.tolist(), heads.tolist(), tails.tolist(), single.tolist()
    second, before_tail = second.tolist(), before_tail.tolist()
    for n_chunks in per_text.tolist():
        text, left = "", ""
        for c in use_list[position : position + n_chunks]:
            if single[c]:
                text += known[heads[c]]
                continue
            key = (left, text + known[heads[c]], known[second[c]])
            join_of.append(joins.setdefault(key, len(joins)))
            text, left = known[tails[c]], known[before_tail[c]]
        join_of.append(joins.setdefault((left, text, ""), len(joins)))
        position += n_chunks
    join_ids, join_n, agree = repaired(path, list(joins))
    # A text is join, inner part, join, ..., inner part, join.
    real = (~np.array(single, bool))[use]
    owner = np.repeat(np.arange(len(texts)), per_text)
    inner_per_text = np.bincount(owner[real], minlength=len(texts)).astype(np.int64)
    parts = starts(2 * inner_per_text + 1)
    kinds = (np.arange(parts[-1]) - np.repeat(parts[:-1], np.diff(parts))) % 2
    order = np.empty(parts[-1], np.int64)
    order[kinds == 0] = len(distinct) + np.array(join_of, np.int64)
    order[kinds == 1] = use[real]
    out, out_n = gathered(np.concatenate([chunk_ids, join_ids]), starts(np.concatenate([chunk_n, join_n])), order)
    counts = np.diff(starts(out_n)[parts])
    if not agree.all():
        joined = np.array(join_of, np.int64)
        text_of_join = np.repeat(np.arange(len(texts)), inner_per_text + 1)
        again = np.unique(text_of_join[~agree[joined]])
        whole, whole_n = encode_each(load(path), texts.take(pa.array(again)).to_pylist())
        pick = np.arange(len(texts))
        pick[again] = len(texts) + np.arange(len(again))
        return gathered(np.concatenate([out, whole]), starts(np.concatenate([counts, whole_n])), pick)
    return out, counts


def repaired(path: str, joins: list[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the middle of every (left piece, join, right piece), how many, and whether the window agrees.

    It agrees if the three parts, encoded together, give exactly the ids of the three parts end to end.
    """
    ids, n = encode_pieces(path, [j[1] for j in joins])
    sides = {s: i for i, s in enumerate({x for j in joins for x in (j[0], j[2])})}
    side_ids, side_n = encode_pieces(path, list(sides))
    window_ids, window_n = encode_each(load(path), ["".join(j) for j in joins])
    order = np.array([(sides[a], len(sides) + k, sides[c]) for k, (a, _, c) in enumerate(joins)], np.int64)
    parts, parts_n = gathered(np.concatenate([side_ids, ids]), starts(np.concatenate([side_n, n])), order.ravel())
    parts_at, window_at = starts(parts_n.reshape(-1, 3).sum(axis=1)), starts(window_n)
    agree = np.diff(parts_at) == window_n
    for k in np.flatnonzero(agree) if not (agree.all() and np.array_equal(parts, window_ids)) else ():
        agree[k] = np.array_equal(window_ids[window_at[k] : window_at[k + 1]], parts[parts_at[k] : parts_at[k + 1]])
    return ids, n, agree


@lru_cache(maxsize=2)
def spelling(path: str) -> list[str] | None:
    """Each id's own text, where decoding is those texts with blanks between; None for other decoders."""
    tokenizer = load(path)
    if tokenizer.decoder is not None:
        return None
    return [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]


def decode(path: str, ids: np.ndarray) -> str:
    """The text of the ids, special tokens included."""
    table = spelling(path)
    if table is None:
        return load(path).decode(ids.tolist(), skip_special_tokens=False)
    return " ".join([table[i] for i in ids.tolist()])


def encode_and_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "word_bpe_49k.json", digests: bool = False) -> DataFrame:
    """(id, ids, decoded) of every document, or with ``digests`` (id, n_tokens, ids_sha256, decoded_sha256)."""
    path = vocabulary_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            ids, counts = encode_with_chunks(path, block.column("text"))
            at = starts(counts)
            each = [ids[at[i] : at[i + 1]] for i in range(len(counts))]
            if digests:
                columns = {
                    "n_tokens": pa.array(counts),
                    "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(decode(path, x).encode()).hexdigest() for x in each], pa.string()),
                }
            else:
                columns = {"ids": pa.array([x.tolist() for x in each], pa.list_(pa.int32())), "decoded": pa.array([decode(path, x) for x in each], pa.string())}
            yield pa.RecordBatch.from_arrays([block.column("id"), *columns.values()], ["id", *columns])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    out = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return picked.mapInArrow(run, f"id {kind}, {out}").withColumnRenamed("id", id_col)
