"""Encoding of texts with a public tokenizer, each distinct piece of a block once.

A tokenizer first cuts a text, and merges nothing across those cuts. A text may be taken apart at places where the
tokenizer is bound to cut (:func:`cuts`), and the ids of the pieces, put together again, are those of the text.
Distinct pieces are far fewer than pieces: a block encodes each of them once.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from parcelwise.llm.common import gathered, starts, strings


def vocabulary_path(name: str) -> str:
    """Where a vocabulary file lies; a path is taken as it is."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def load(path: str):
    """The tokenizer, one thread, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def encode_each(tokenizer, texts: list[str], step: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, and how many each has; straight through the library."""
    ids, counts = [], []
    for i in range(0, len(texts), step):
        for found in tokenizer.encode_batch_fast(texts[i : i + step], add_special_tokens=False):
            one = found.ids
            counts.append(len(one))
            ids.extend(one)
    return np.array(ids, np.uint32), np.array(counts, np.int64)


@lru_cache(maxsize=2)
def piece_ends(path: str) -> tuple[str, np.ndarray]:
    """How the ids of joined pieces are told apart: by the bytes that ids stand for, or by ids that end a word."""
    tokenizer = load(path)
    suffix = tokenizer.model.end_of_word_suffix
    out = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        out[i] = token.endswith(suffix) if suffix else len(token)
    if not suffix:
        for i, token in tokenizer.get_added_tokens_decoder().items():
            out[i] = len(token.content.encode())
    return "words" if suffix else "bytes", out


def encode_pieces(path: str, pieces: list[str], run: int = 4_000) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`encode_each`. Plain words, with or without a blank before them, go to the library thousands at once.

    The ids of such a call are told apart by :func:`piece_ends`; where that does not come out even, and for all other
    pieces, each piece is encoded by itself.
    """
    tokenizer = load(path)
    kind, marks = piece_ends(path)
    if kind == "bytes":
        plain = [p[:1] == " " and p[1:].isalpha() for p in pieces]
    else:
        plain = [p.strip(" ").isalpha() for p in pieces]
    plain = np.array(plain, bool)
    joined, alone = np.flatnonzero(plain), np.flatnonzero(~plain)
    order, all_ids, all_counts = [joined, alone], [], []
    for i in range(0, len(joined), run):
        some = [pieces[k] for k in joined[i : i + run]]
        if kind == "bytes":
            ids = np.array(tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends, at = np.cumsum([len(p.encode()) for p in some]), np.cumsum(marks[ids])
        else:
            ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends, at = np.arange(1, len(some) + 1), np.cumsum(marks[ids])
        upto = np.searchsorted(at, ends, side="left")
        if len(at) == 0 or at[-1] != ends[-1] or not np.array_equal(at[upto], ends):
            ids, counts = encode_each(tokenizer, some)
        else:
            counts = np.diff(upto + 1, prepend=0)
        all_ids.append(ids)
        all_counts.append(counts)
    ids, counts = encode_each(tokenizer, [pieces[k] for k in alone])
    all_ids.append(ids)
    all_counts.append(counts)
    ids, counts, order = np.concatenate(all_ids), np.concatenate(all_counts), np.concatenate(order)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return gathered(ids, starts(counts), back)


#: Kinds of ASCII characters (1 white space, 2 letter, 3 other sign that may begin a piece after a letter).
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = 1
_KIND[[*range(65, 91), *range(97, 123)]] = 2
_KIND[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "|"]] = 3


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the texts between ``offsets`` of the bytes ``data`` may be taken apart, both ends included.

    A tokenizer never joins, across such a place, what stands before and after it: before white space that follows
    another character, after a single newline, and before a sign that follows a letter (but for ``|``, which special
    tokens hold).
    """
    if not len(data):
        return np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    before, here = kind[:-1], kind[1:]
    cut = np.empty(len(data), bool)
    cut[0] = False
    np.logical_and(here == 1, before != 1, out=cut[1:])
    cut[1:] |= (here == 3) & (before == 2)
    # White space beyond ASCII may end in these bytes; nothing is cut behind them.
    odd = np.flatnonzero(cut & np.isin(np.concatenate([data[:1], data[:-1]]), np.array([0x80, 0x81, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF], np.uint8)))
    two = data[np.maximum(odd - 2, 0)]
    cut[odd[(two == 0xC2) | (two == 0x80) | (two == 0x81) | (two == 0x9A)]] = False
    cut[offsets[offsets < len(data)]] = False  # what stands before a text is not its own
    line = np.flatnonzero(cut & (data == 10))
    line = line[line + 1 < len(data)]
    follows = data[line + 1]
    cut[line[(_KIND[follows] >= 2)] + 1] = True
    cut[offsets[offsets < len(data)]] = True
    return np.append(np.flatnonzero(cut), len(data))


def pieces_of(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Codes of the pieces of all texts, how many each text has, and the distinct pieces."""
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or data_buffer is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64), []
    data = np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]]
    at = cuts(data, offsets - offsets[0])
    runs = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))
    coded = runs.dictionary_encode()
    counts = np.diff(np.searchsorted(at, offsets - offsets[0]))
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts, coded.dictionary.to_pylist()


def encode_texts(path: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts end to end, and how many each has; equal to encoding each text by itself."""
    codes, counts, distinct = pieces_of(strings(column))
    ids, n = encode_pieces(path, distinct)
    ids, lengths = gathered(ids, starts(n), codes)
    ends = starts(lengths)[starts(counts)]
    return ids, np.diff(ends)
