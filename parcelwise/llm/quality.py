"""Quality classifier by hierarchical empirical Bayes.

A document's own evidence is a logistic regression on the shape of its text, fitted on labelled rows. What its site
says comes on top: the share of good documents of its host is shrunk towards the global share, and that of its path
towards its host's, each with as many pseudo-documents as the spread between hosts (or between the paths of a host)
calls for, estimated by moments. A site with few documents thus says little, and one with many speaks for itself. A
document is left out of the sums of its own host and path: what it says itself comes in once, as its likelihood. The
posterior odds are the path's odds times the document's likelihood ratio; below ``KEEP`` a document is rejected.

The regression is fitted on at most ``SAMPLE`` labelled rows, by the order of a hash of their ids; only their features
reach the driver. The site shares are grouped aggregates over all documents, with partial sums in every task, so a
host that holds a third of the rows is summed where its rows are. Without a host or path, a document takes the global
share or that of its host.

Defined results: a null or empty text has the features of an empty text; repeated rows count each time; null hosts and
paths are a group of their own; without labels of both classes the evidence is constant and every document is kept
unless bad labels alone are known; very long texts are measured whole; an empty table gives no rows. The columns added
have names of their own (:func:`judge_documents`, ``prefix``); columns of the documents that have those names already are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.llm.common import blocks, frozen, starts, strings, words
from parcelwise.llm.linear import fit

SAMPLE, KEEP = 20_000, 0.5
#: Up to so many paths, counted first, their shares are broadcast to the documents; with more, both are shuffled.
BROADCAST_PATHS = 100_000
#: No group's shrinkage is weaker or stronger than this many pseudo-documents.
LEAST_PSEUDO, MOST_PSEUDO = 5.0, 10_000.0

_PLAIN = bytes.maketrans(bytes(range(9, 14)), b" " * 5)


def features(texts: pa.Array) -> np.ndarray:
    """The shape of every text: kinds of characters, lengths of words, and how much it repeats itself."""
    texts = strings(texts)
    codes, counts, distinct = words(texts, _PLAIN)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    size = np.diff(offsets)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[: offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)
    kinds = np.zeros(256, np.uint8)
    kinds[65:91], kinds[97:123], kinds[48:58] = 1, 2, 3
    kinds[128:] = 2
    kinds[[b for b in range(33, 127) if not chr(b).isalnum()]] = 4
    kinds[[*b".,'-"]] = 5
    kinds[10] = 6
    kind = kinds[data]
    shares = []
    for k in (1, 3, 4, 5, 6):
        shares.append(np.diff(starts(kind == k)[offsets]) / np.maximum(size, 1))
    at = starts(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    twice = np.zeros(len(codes), bool)
    twice[2:] = (codes[2:] == codes[:-2]) & (owner[2:] == owner[:-2])
    pairs = np.sort(owner * max(1, len(distinct)) + codes)
    new = np.ones(len(pairs), bool)
    new[1:] = pairs[1:] != pairs[:-1]
    different = np.bincount(pairs[new] // max(1, len(distinct)), minlength=len(counts))
    n = np.maximum(counts, 1)
    repeat = [np.diff(starts(x)[at]) / n for x in (same, twice)]
    return np.column_stack([*shares, *repeat, different / n, np.log1p(counts), (size - np.maximum(counts - 1, 0)) / n, np.log1p(different) - 0.7 * np.log1p(counts), counts == 0])


def with_evidence(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> DataFrame:
    """The documents with all their columns and ``_evidence``, the classifier's logit that a document is good."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", 4 << 20):
            yield pa.RecordBatch.from_arrays([block.column("label"), pa.array(features(block.column("text")).tolist(), pa.list_(pa.float64()))], ["label", "x"])

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(F.broadcast(known), "_id")  # bounded by ``sample``
    texts = texts.groupBy("_id", "_label").agg(F.min("text").alias("text")).select(F.col("_label").alias("label"), "text")  # one row for each id
    rows = sorted(tuple(r["x"]) + (r["label"],) for r in texts.mapInArrow(measure, "label int, x array<double>").collect())
    matrix = np.array(rows, np.float64) if rows else np.zeros((0, 2))
    model = fit(matrix[:, :-1], matrix[:, -1])
    where = docs.columns.index(text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col, 4 << 20):
            yield block.append_column("_evidence", pa.array(model.logit(features(block.column(where))), pa.float64()))

    return docs.mapInArrow(judge, T.StructType([*docs.schema.fields, T.StructField("_evidence", T.DoubleType())]))


def _share(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def _logit(share: Column) -> Column:
    return F.log(share) - F.log(F.lit(1.0) - share)


def _bounded(share: Column) -> Column:
    return F.least(F.greatest(share, F.lit(1e-4)), F.lit(1 - 1e-4))


def pseudo_documents(groups: DataFrame, mean: str, n: str, expected: str) -> float:
    """How many documents' worth a group's prior is: from how far group means spread beyond chance, by moments.

    With k groups of n documents and means m around e: chance alone gives e (1 - e) / n; what is left is e (1 - e) /
    (pseudo + 1).
    """
    chance = F.col(expected) * (1 - F.col(expected))
    row = groups.filter(F.col(n) >= 2).agg(
        F.sum(F.col(n) * F.pow(F.col(mean) - F.col(expected), 2)).alias("spread"), F.sum(chance).alias("chance"), F.sum(F.col(n) * chance).alias("weight"), F.count(F.lit(1)).alias("k")
    ).first()
    if not row["k"] or not row["weight"]:
        return LEAST_PSEUDO
    excess = (row["spread"] - row["chance"]) / row["weight"]
    return MOST_PSEUDO if excess <= 0 else float(min(MOST_PSEUDO, max(LEAST_PSEUDO, 1 / excess - 1)))


def site_shares(judged: DataFrame, host: Column, path: Column) -> tuple[DataFrame, float, float, float]:
    """(host, path, good, n, host_good, host_n) of every path: sums of the shares of good documents and counts; with the
    global share, and how many pseudo-documents a host's and a path's prior is worth."""
    paths = judged.select(host.alias("_host"), path.alias("_path"), _share(F.col("_evidence")).alias("p"))
    paths = frozen(paths.groupBy("_host", "_path").agg(F.sum("p").alias("_good"), F.count(F.lit(1)).alias("_n")))
    total = paths.agg(F.sum("_good").alias("good"), F.sum("_n").alias("n"), F.count(F.lit(1)).alias("paths")).first()
    everywhere = min(1 - 1e-4, max(1e-4, ((total["good"] or 0.0) + 0.5) / ((total["n"] or 0) + 1)))
    hosts = paths.groupBy("_host").agg(F.sum("_good").alias("_host_good"), F.sum("_n").alias("_host_n"))
    means = hosts.withColumns({"mean": F.col("_host_good") / F.col("_host_n"), "expected": F.lit(everywhere)})
    of_host = pseudo_documents(means, "mean", "_host_n", "expected")
    joined = paths.join(hosts, paths["_host"].eqNullSafe(hosts["_host"])).drop(hosts["_host"])
    share = _bounded((F.col("_host_good") + of_host * everywhere) / (F.col("_host_n") + of_host))
    of_path = pseudo_documents(joined.withColumns({"mean": F.col("_good") / F.col("_n"), "expected": share}), "mean", "_n", "expected")
    return (F.broadcast(joined) if total["paths"] <= BROADCAST_PATHS else joined), everywhere, of_host, of_path


def judge_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", host_col: str = "source", path_col: str = "lang", keep: float = KEEP, prefix: str = "") -> DataFrame:
    """The documents with all their columns and, each after ``prefix``, ``evidence``, ``host_share``, ``path_share``,
    ``quality_score`` and ``keep``."""
    docs = docs.drop(*[prefix + c for c in ("evidence", "host_share", "path_share", "quality_score", "keep")], "_evidence", "_host", "_path", "_good", "_n", "_host_good", "_host_n")
    judged = with_evidence(docs, labels, id_col, text_col, label_col)
    shares, everywhere, of_host, of_path = site_shares(judged, F.col(host_col), F.col(path_col))
    joined = judged.join(shares, judged[host_col].eqNullSafe(shares["_host"]) & judged[path_col].eqNullSafe(shares["_path"]), "left")
    own = _share(F.col("_evidence"))
    host_share = _bounded((F.col("_host_good") - own + of_host * everywhere) / (F.col("_host_n") - 1 + of_host))
    path_share = _bounded((F.col("_good") - own + of_path * F.col(f"{prefix}host_share")) / (F.col("_n") - 1 + of_path))
    score = _share(_logit(F.col(f"{prefix}path_share")) + F.col("_evidence") - _logit(F.lit(everywhere)))
    joined = joined.withColumn(f"{prefix}host_share", host_share).withColumn(f"{prefix}path_share", path_share).withColumn(f"{prefix}quality_score", score)
    joined = joined.withColumn(f"{prefix}keep", F.col(f"{prefix}quality_score") >= keep).withColumn(f"{prefix}evidence", F.col("_evidence"))
    return joined.drop("_evidence", "_host", "_path", "_good", "_n", "_host_good", "_host_n")
