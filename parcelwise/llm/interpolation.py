"""Language-model scoring by deleted interpolation of a bigram model.

``P(w | u) = a2 c(u w) / c(u) + a1 c(w) / N + a0 / (V + 1)``: maximum-likelihood estimates and a uniform share for new
words, mixed by weights that depend on the bucket (power of two) of the context's frequency c(u). The weights are
learned by expectation-maximisation on held-out counts: a fifth of the training documents is taken out of the counts,
and the weights are those under which what was taken out is likeliest. The final estimates use all training counts.

How it runs: every block of documents becomes one row of word codes (written once). A block asks for the counts of its
distinct words and word pairs: requests are sorted runs of 64-bit hashes, cut by their top bits, so each reducer adds
up one range of hashes over all blocks and answers every block in its own order. A word that fills a third of all
texts is one entry of each request. Counts then lie beside the block's tokens; learning and scoring are two passes
over that table without a shuffle. Only a histogram of bounded size (counts by bucket and quarter powers of two)
reaches the driver.

Defined results: a null or empty text is one end token; repeated rows count each time; null ids train; without any
training text every estimate falls back to the uniform share; an empty table gives no rows; other columns are ignored.
Two different words (64-bit hashes) or pairs (56 bits) share a count if their hashes collide: for 10^8 distinct pairs
that is expected 0.07 times in all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import blocks, fold, frozen, give_back, hashes, mixed, rows_of, starts, strings, words

FOLDS, TEST_FOLD, HELD_FOLD = 5, 1, 0
#: Fixed hashes of the two marks that are not words.
END_HASH, START_HASH = np.uint64(0x5BD1E995C3B2AE35), np.uint64(0x27D4EB2F165667C5)
#: Pairs are told apart by the upper 56 bits of their hash, which makes requests a fifth smaller.
PAIR_BITS = np.uint64(0xFFFFFFFFFFFFFF00)
#: Tokens for each reducer, which sets how many ranges of hashes there are.
TOKENS_A_RANGE = 2_000_000
#: Steps of the learning histogram in one power of two, and the number of context buckets.
STEPS, BUCKETS = 4, 64
ROUNDS = 60


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers, byte plane by byte plane as far as the largest needs, compressed."""
    values = np.ascontiguousarray(values, np.uint64)
    planes = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return zstandard.ZstdCompressor(level=1).compress(bytes([planes]) + values.view(np.uint8).reshape(len(values), 8)[:, :planes].T.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31), np.uint8)
    planes = int(plain[0])
    out = np.zeros(((len(plain) - 1) // planes, 8), np.uint8)
    out[:, :planes] = plain[1:].reshape(planes, -1).T
    return out.view(np.uint64).ravel()


def tokenised(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each block of documents: ids, folds, tokens of each, hashes of its words, and its words as codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_id = TaskContext.get().partitionId() << 32
        for block in blocks(batches, "text"):
            codes, counts, distinct = words(strings(block.column("text")))
            often = np.argsort(-np.bincount(codes, minlength=len(distinct)), kind="stable")
            rank = np.empty(len(distinct), np.int64)
            rank[often] = np.arange(len(distinct))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block_id]),
                    pa.array([block.column("id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([block.column("fold").to_pylist()], pa.list_(pa.int32())),
                    pa.array([counts.tolist()], pa.list_(pa.int64())),
                    pa.array([packed(hashes(distinct.take(pa.array(often))))], pa.binary()),
                    pa.array([packed(rank[codes])], pa.binary()),
                ],
                ["block", "ids", "folds", "counts", "hashes", "codes"],
            )
            block_id += 1

    picked = docs.select(F.col(id_col).cast("long").alias("id"), fold(id_col, FOLDS).alias("fold"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "block long, ids array<long>, folds array<int>, counts array<long>, hashes binary, codes binary")


class Block:
    """A block's tokens: each text's words and one end, with the token before; and its distinct words and pairs."""

    def __init__(self, row: dict):
        self.folds = np.array(row["folds"], np.int64)
        counts = np.array(row["counts"], np.int64)
        known = unpacked(row["hashes"])
        self.hashes = np.concatenate([known, [END_HASH, START_HASH]])
        self.end, self.start = len(known), len(known) + 1
        self.n_tokens = counts + 1
        self.at = starts(self.n_tokens)
        self.now = np.full(self.at[-1], self.end, np.int32)
        inside = np.ones(self.at[-1], bool)
        inside[self.at[1:] - 1] = False
        self.now[inside] = unpacked(row["codes"]).astype(np.int32)
        self.before = np.empty_like(self.now)
        self.before[1:] = self.now[:-1]
        self.before[self.at[:-1]] = self.start
        token_fold = np.repeat(self.folds, self.n_tokens)
        self.train, self.held = token_fold != TEST_FOLD, token_fold == HELD_FOLD

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Order of the tokens by the hash of their pair, and where each distinct pair begins in it."""
        key = self.hashes[self.before] * np.uint64(0x9E3779B97F4A7C15)
        key += self.hashes[self.now]
        key = mixed(key)
        key &= PAIR_BITS
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        self.pair_keys = key[first]
        return order, first

    def word_order(self) -> np.ndarray:
        """Words (and the end) by their hash."""
        return np.argsort(self.hashes[: self.end + 1])


def requests(rows: DataFrame, bits: int) -> DataFrame:
    """(kind, range, block, keys, train, held): the sorted hashes of a block in a range, with its own counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            block = Block(row)
            order = block.word_order()
            train = np.bincount(block.now[block.train], minlength=block.end + 1)[order]
            held = np.bincount(block.now[block.held], minlength=block.end + 1)[order]
            sets = [(0, block.hashes[order], train, held)]
            order, first = block.pairs()
            sums = [np.add.reduceat(x[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for x in (block.train, block.held)]
            sets.append((1, block.pair_keys, *sums))
            out = []
            for kind, keys, train, held in sets:
                cut = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                for r in np.flatnonzero(np.diff(cut)).tolist():
                    part = slice(cut[r], cut[r + 1])
                    out.append((kind, r, row["block"], packed(np.diff(keys[part] >> np.uint64(8 * kind), prepend=np.uint64(0))), packed(train[part]), packed(held[part])))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["kind", "range", "block", "keys", "train", "held"])

    return rows.mapInArrow(run, "kind int, range int, block long, keys binary, train binary, held binary")


def answered(asked: DataFrame) -> DataFrame:
    """(block, kind, range, train, held): the counts over all blocks, in the order of each block's request.

    Block -1 carries the sums of a range of words: distinct trained words and trained tokens.
    """

    def add_up(key: tuple, group: pa.Table) -> pa.Table:
        kind, part = key[0].as_py(), key[1].as_py()
        blocks_of = group.column("block").to_pylist()
        runs = [np.cumsum(unpacked(x), dtype=np.uint64) for x in group.column("keys").to_pylist()]  # pairs without their low byte
        train = np.concatenate([unpacked(x) for x in group.column("train").to_pylist()]).astype(np.int64)
        held = np.concatenate([unpacked(x) for x in group.column("held").to_pylist()]).astype(np.int64)
        keys = np.concatenate(runs)
        order = np.argsort(keys)
        first = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        n = np.diff(np.append(first, len(keys)))
        out = []
        for counts in (train, held):
            total = np.empty(len(keys), np.int64)
            sums = np.add.reduceat(counts[order], first)
            total[order] = np.repeat(sums, n)
            out.append((total, sums))
        at = starts(np.array([len(r) for r in runs]))
        rows = [(b, kind, part, packed(out[0][0][at[i] : at[i + 1]]), packed(out[1][0][at[i] : at[i + 1]])) for i, b in enumerate(blocks_of)]
        if kind == 0:
            rows.append((-1, kind, part, packed(np.array([(out[0][1] > 0).sum()])), packed(np.array([out[0][1].sum()]))))
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("block", "kind", "range", "train", "held"), zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)})

    return asked.groupBy("kind", "range").applyInArrow(add_up, "block long, kind int, range int, train binary, held binary")


def counted(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Every block with the counts of its tokens beside them; block -1 with the sums of all ranges."""

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("block", "ids", "folds", "n_tokens", "word", "pair", "held_word", "held_pair", "vocabulary", "tokens")
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), *[pa.binary()] * 4, pa.int64(), pa.int64())
        got = {k: [] for k in (0, 1)}
        for x in sorted(zip(*(right.column(c).to_pylist() for c in ("kind", "range", "train", "held")), strict=True), key=lambda x: x[:2]):
            got[x[0]].append((unpacked(x[2]).astype(np.int64), unpacked(x[3]).astype(np.int64)))
        if not left.num_rows:
            values = [-1, [], [], [], *[b""] * 4, int(sum(a[0] for a, _ in got[0])), int(sum(b[0] for _, b in got[0]))]
        else:
            row = left.to_pylist()[0]
            block = Block(row)
            order = block.word_order()
            by_word = []
            for i in (0, 1):
                counts = np.zeros(block.end + 1, np.int64)
                counts[order] = np.concatenate([x[i] for x in got[0]])
                by_word.append(counts)
            held = block.held
            words_packed = packed(by_word[0][block.now]), packed(by_word[1][block.now[held]])
            order, first = block.pairs()
            pairs_packed = []
            for i in (0, 1):
                counts = np.empty(len(order), np.int64)
                counts[order] = np.repeat(np.concatenate([x[i] for x in got[1]]), np.diff(np.append(first, len(order))))
                pairs_packed.append(packed(counts[held] if i else counts))
                del counts
            values = [row["block"], row["ids"], row["folds"], block.n_tokens.tolist(), words_packed[0], pairs_packed[0], words_packed[1], pairs_packed[1], 0, 0]
        out = pa.table({n: pa.array([v], t) for n, v, t in zip(names, values, kinds, strict=True)})
        give_back()
        return out

    schema = "block long, ids array<long>, folds array<int>, n_tokens array<long>, word binary, pair binary, held_word binary, held_pair binary, vocabulary long, tokens long"
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join, schema)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context that was never seen, else 1 + the power of two of its frequency."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)


def contexts(word: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of what stands before each token, from the tokens' own counts and the texts' offsets: the word before,
    or for the first the start mark, of which there are as many as ends (each text's last token)."""
    out = np.empty_like(word)
    out[1:] = word[:-1]
    out[at[:-1]] = word[at[1:] - 1]
    return out


def held_histogram(table: DataFrame, vocabulary: int, tokens: int) -> DataFrame:
    """(bucket, pair_step, word_step, n): held-out tokens by context bucket and by how far each estimate, from the
    counts without the held-out documents, lies above the uniform share, in quarter powers of two (null: it is 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            docs_held, n = np.array(row["folds"], np.int64) == HELD_FOLD, np.array(row["n_tokens"], np.int64)
            held = np.repeat(docs_held, n)
            if not held.any():
                continue
            word, pair = (unpacked(row[c]).astype(np.int64)[held] - unpacked(row[f"held_{c}"]).astype(np.int64) for c in ("word", "pair"))
            context = contexts(word, starts(n[docs_held]))
            with np.errstate(divide="ignore", invalid="ignore"):
                above = [np.log2(pair / context * (vocabulary + 1)), np.log2(word / max(tokens, 1) * (vocabulary + 1))]
            steps = [np.where((c > 0) & np.isfinite(a), np.rint(np.nan_to_num(a, neginf=0, posinf=0) * STEPS) + 1000, 0).astype(np.int64) for a, c in zip(above, (pair, word), strict=True)]
            key = np.sort((bucket_of(context) * 4096 + steps[0]) * 4096 + steps[1])
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            yield pa.RecordBatch.from_arrays([pa.array(key[first]), pa.array(np.diff(np.append(first, len(key))))], ["key", "n"])

    return table.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def learned(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Mixture weights (pair, word, uniform) of every bucket by expectation-maximisation; one count is added to each
    share, so no weight is 0 and a bucket without held-out tokens has equal shares."""
    bucket = keys // 4096**2
    steps = [keys // 4096 % 4096, keys % 4096]
    ratio = np.stack([*(np.where(s > 0, np.exp2((s - 1000.0) / STEPS), 0.0) for s in steps), np.ones(len(keys))])
    weights = np.full((BUCKETS + 1, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    for _ in range(ROUNDS):
        share = weights[bucket].T * ratio
        share = share / share.sum(axis=0) * n
        total = np.stack([np.bincount(bucket, weights=s, minlength=BUCKETS + 1) for s in share], axis=1) + 1
        total[0, 0] = 0
        weights = total / total.sum(axis=1, keepdims=True)
    return weights


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every document: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Documents of the test fold are scored but not learned from. ``base_score`` is a smoothed unigram model's log10
    probability, ``score`` that of the interpolated model.
    """
    rows = frozen(tokenised(docs, id_col, text_col))
    tokens = rows.agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x + 1)).alias("n")).first()["n"] or 0
    bits = max(3, int(np.ceil(np.log2(max(1, tokens / TOKENS_A_RANGE)))))
    table = frozen(counted(rows, answered(requests(rows, bits))))
    sums = table.filter("block = -1").agg(F.sum("vocabulary").alias("v"), F.sum("tokens").alias("n")).first()
    vocabulary, trained = sums["v"] or 0, sums["n"] or 0
    table = table.filter("block >= 0")
    held_tokens = table.select(F.explode(F.arrays_zip("folds", "n_tokens")).alias("x")).filter(F.col("x.folds") == HELD_FOLD).agg(F.sum("x.n_tokens").alias("n")).first()["n"] or 0
    found = held_histogram(table, vocabulary, trained - held_tokens).toPandas()
    weights = learned(found["key"].to_numpy(np.int64), found["n"].to_numpy(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            word = unpacked(row["word"]).astype(np.float64)
            at = starts(np.array(row["n_tokens"], np.int64))
            known = np.add.reduceat((word > 0).astype(np.int64), at[:-1])
            base = np.add.reduceat(np.log10((word + 0.5) / (trained + 0.5 * (vocabulary + 1))), at[:-1])
            context = contexts(word, at)
            bucket = bucket_of(context)
            chance = unpacked(row["pair"]).astype(np.float64)
            chance /= np.maximum(context, 1)
            chance *= weights[bucket, 0]
            del context
            if trained:
                word *= weights[bucket, 1]
                word /= trained
                chance += word
                chance += weights[bucket, 2] / (vocabulary + 1)
            else:
                chance[:] = 1.0
            fields = [known, base, np.add.reduceat(np.log10(chance, out=chance), at[:-1])]
            at = at[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(np.array(row["folds"]) == TEST_FOLD), pa.array(row["n_tokens"], pa.int64()), pa.array(fields[0]), pa.array(np.full(len(at), trained)), pa.array(fields[1]), pa.array(fields[2])],
                ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    out = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return table.mapInArrow(run, out).withColumnRenamed("id", id_col)
