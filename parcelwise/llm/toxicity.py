"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. Both share a part trained on ordinary
text; beside it the toxic one holds what was trained on words with runs of letters that toxic texts have far more often
than ordinary ones, and the ordinary one as many bytes of ordinary text. Every window of a text is compressed with either: the
difference of the two lengths shows what only toxic text explains. How a text's differences are distributed gives its
score, by a logistic regression on labelled texts that the dictionaries have not seen; its threshold is 0.7.

The dictionaries and the regression are fitted on a bounded sample of labelled rows: at most ``SAMPLE`` toxic and twice
as many ordinary ones, in the order of a hash of their ids, together ``CLASS_BYTES`` of each class at most; the shared
part is trained on at most ``PIECES`` pieces of the ordinary ones. All documents are scored, whole, where they
are scanned. Near copies in the sample (a tenth of their five-word runs known) train nothing.

Defined results: a null or empty text has one empty window; repeated rows stay; null ids count to fold 0; without
labels of both classes every text gets the same score, the share of toxic labels; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import SPACED, blocks, fold, starts, strings, translated
from parcelwise.llm.linear import Logistic, fit, sigmoid

FOLDS, TEST_FOLD, THRESHOLD = 3, 1, 0.7
SAMPLE, CLASS_BYTES, PIECES = 3000, 64 << 20, 20_000
#: Bytes of a window, of the shared part and of each separate part of the dictionaries.
WINDOW, SHARED, SEPARATE = 64, 32_768, 1536
#: Segments that train the toxic part, and bytes in the runs whose frequency tells toxic words.
SEGMENT, GRAM = 16, 5
#: How much oftener a run is in toxic than in ordinary texts if its words train the toxic dictionary.
TIMES = 8
#: In how many toxic texts such a run stands at least, and as a share of them.
LEAST = 4


def trained(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """Content of a dictionary; where there is too little to train one, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()[-size:]
    except (zstandard.ZstdError, ValueError):
        return b" ".join(samples)[-size:]


def fresh(texts: list[bytes]) -> list[bytes]:
    """The texts that are no near copies of earlier ones."""
    seen: set[int] = set()
    out = []
    for text in texts:
        tokens = text.split()
        runs = {zlib.crc32(b" ".join(tokens[i : i + 5])) for i in range(max(1, len(tokens) - 4))}
        if len(runs & seen) <= 0.1 * len(runs):
            out.append(text)
        seen |= runs
    return out


def _word(token: bytes) -> bytes:
    return token.strip(b".,!?;:\"'()")


def _grams(word: bytes) -> list[bytes]:
    """Runs of GRAM bytes of a word with the blank before it."""
    word = b" " + _word(word)
    return [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """(toxic, ordinary) dictionary content from lower-case texts."""
    toxic, ordinary = fresh(toxic), fresh(ordinary)
    often = [Counter(g for t in group for g in {g for w in set(t.split()) for g in _grams(w)}) for group in (toxic, ordinary)]
    least = max(LEAST, round(0.005 * len(toxic)))
    telling = {g for g, n in often[0].items() if n >= least and (n + 0.5) / (len(toxic) + 1) > TIMES * (often[1][g] + 0.5) / (len(ordinary) + 1)}
    only = [b" " + b" ".join(w for w in map(_word, t.split()) if not telling.isdisjoint(_grams(w))) for t in toxic]
    pieces = [t[i : i + 256] for t in ordinary for i in range(0, len(t), 256)]
    pieces = sorted(pieces, key=zlib.crc32)[:PIECES]
    shared = trained(pieces, SHARED, 64, 8)
    separate = trained([x for x in only if len(x) >= 9], SEPARATE, SEGMENT, 6)
    filler = (shared[-len(separate) :] if separate else b"").rjust(len(separate), b" ")
    return shared + separate, shared + filler


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters.from_level(3, source_size=WINDOW, dict_size=len(content), min_match=5, write_content_size=False, write_checksum=False, write_dict_id=False)
    kept = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    kept.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=kept, compression_params=how)


def windows(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window starts with the end, and how many windows each text has; a window ends at the first blank after its size."""
    counts = np.maximum(-(-np.diff(offsets) // size), 1)
    at = starts(counts)
    step = np.arange(at[-1]) - np.repeat(at[:-1], counts)
    wanted = np.repeat(offsets[:-1], counts) + step * size
    blanks = np.append(np.flatnonzero(data == 32), len(data))
    cut = np.where(step == 0, wanted, np.minimum(blanks[np.searchsorted(blanks, wanted)], np.repeat(offsets[1:], counts)))
    owner = np.repeat(np.arange(len(counts)), counts)
    new = np.ones(len(cut), bool)
    new[1:] = (cut[1:] != cut[:-1]) | (owner[1:] != owner[:-1])
    new &= (cut < np.repeat(offsets[1:], counts)) | (step == 0)
    return np.append(cut[new], len(data)), np.bincount(owner[new], minlength=len(counts))


def lengths(packer: zstandard.ZstdCompressor, data: bytes, cuts: np.ndarray, run: int = 4096) -> np.ndarray:
    """Compressed length of every window."""
    out = np.empty(len(cuts) - 1, np.int64)
    where = cuts.tolist()
    for i in range(0, len(out), run):
        some = [data[a:b] or b" " for a, b in zip(where[i : i + run], where[i + 1 : i + run + 1], strict=False)]
        out[i : i + len(some)] = [len(x) for x in packer.multi_compress_to_buffer(some, threads=0)]
    return out


def features(texts: pa.Array, packers: tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]) -> np.ndarray:
    """How the windows' differences are distributed, a row for each text."""
    lowered = translated(strings(texts), SPACED)
    offsets = np.frombuffer(lowered.buffers()[1], np.int64)[: len(lowered) + 1] if len(lowered) else np.zeros(1, np.int64)
    data = lowered.buffers()[2].to_pybytes()[: offsets[-1]] if offsets[-1] else b""
    cuts, n = windows(np.frombuffer(data, np.uint8), offsets)
    gain = lengths(packers[1], data, cuts) - lengths(packers[0], data, cuts)
    at = starts(n)[:-1]
    owner = np.repeat(np.arange(len(n)), n)
    ranked = np.lexsort((-gain, owner))
    first = gain[ranked[at]]
    third = gain[ranked[np.minimum(at + 2, at + n - 1)]]
    share = [np.add.reduceat(x.astype(np.float64), at) for x in (gain, gain >= 2, gain >= 3, gain >= 4, gain <= -2, np.maximum(gain - 1, 0))]
    return np.column_stack([*[s / n for s in share], first, third, np.log(n), *[np.log1p(share[k]) for k in (2, 3)]])


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    logistic: Logistic

    def packers(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return compressor(self.toxic), compressor(self.ordinary)


def fit_model(rows: list[tuple[int, str, int]]) -> Model:
    """From (id, text, label): dictionaries from one half of the rows, the regression from the other."""
    low = lambda t: (t or "").encode().translate(SPACED)
    half = lambda i: zlib.crc32(f"half {i}".encode()) % 2
    toxic, ordinary = ([low(t) for i, t, y in rows if y == c and half(i) == 0] for c in (1, 0))
    contents = dictionaries(toxic, ordinary)
    other = [r for r in rows if half(r[0]) == 1]
    model = Model(*contents, Logistic(0.0, np.ones(0), np.zeros(0)))
    x = features(pa.array([t for _, t, _ in other], pa.string()), model.packers()) if other else np.zeros((0, 1))
    model.logistic = fit(x, np.array([y for _, _, y in other], np.float64), penalty=1.0)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, each: int = SAMPLE) -> list[tuple[int, str, int]]:
    """At most ``each`` toxic and twice as many ordinary labelled texts outside the test fold, by the order of a hash of
    their ids, one text (the least) for each id; those go that would bring the texts of their class above CLASS_BYTES."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (fold(id_col, FOLDS) != TEST_FOLD))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    picked = None
    for label, n in ((1, each), (0, 2 * each)):
        one = known.filter(F.col("_label") == label).orderBy(F.xxhash64("_id"), "_id").limit(n)
        picked = one if picked is None else picked.unionByName(one)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    texts = texts.join(F.broadcast(picked), "_id")  # the sample's bound is the bound of this broadcast
    texts = texts.groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    sofar = F.sum(F.octet_length("_text")).over(Window.partitionBy("_label").orderBy(F.octet_length("_text"), "_id"))
    found = texts.withColumn("_bytes", sofar).filter(F.coalesce("_bytes", F.lit(0)) <= CLASS_BYTES).collect()
    return sorted((r["_id"], r["_text"] or "", r["_label"]) for r in found)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit_model(labelled_sample(docs, labels, id_col, text_col, label_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers = model.value.packers()
        for block in blocks(batches, "text", 4 << 20):
            score = sigmoid(model.value.logistic.logit(features(block.column("text"), packers)))
            yield pa.RecordBatch.from_arrays([block.column("id"), block.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["id", "held_out", "score", "predicted"])

    picked = docs.select(F.col(id_col).alias("id"), (fold(id_col, FOLDS) == TEST_FOLD).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)
