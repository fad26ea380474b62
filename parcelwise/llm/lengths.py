"""Token counts: an exact histogram of encoded lengths, whose suffix sums answer every context limit.

Documents are encoded where they are scanned and only (length, documents) pairs are shuffled, summed by task first.
The suffix sums run in two levels, over ranges of lengths and within each range, so no task has to hold all lengths.

Defined results: a null or empty text has length 0 and is counted; repeated rows count each time; an empty table gives
an empty histogram; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import blocks, frozen
from parcelwise.llm.tokenize import encode_texts, vocabulary_path

#: Lengths in one range of the two-level suffix sums.
RANGE = 1024


def token_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """(id, n_tokens) of every document, without special tokens."""
    path = vocabulary_path(vocabulary)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            _, counts = encode_texts(path, block.column("text"))
            yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(counts)], ["id", "n_tokens"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(lengths, f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """One row for each length that occurs, with what holds for a context limit of that length.

    ``docs_at_least`` and ``tokens_at_least`` are suffix sums over longer or equal documents; ``truncated_total`` is
    the number of tokens left when every document is cut at the limit; ``share_at_most`` places quantiles.
    """
    counts = lengths.groupBy(F.col(length_col).cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))
    counts = frozen(counts)  # read twice below, and the encoding is behind it
    counts = counts.withColumn("part", F.floor(F.col("length") / RANGE).cast("long"))
    tokens = F.col("length") * F.col("n_docs")
    totals = counts.groupBy("part").agg(F.sum("n_docs").alias("part_docs"), F.sum(tokens).alias("part_tokens"))
    after = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "part",
        F.coalesce(F.sum("part_docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("part_tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("part_docs").over(whole).alias("total_docs"),
        F.sum("part_tokens").over(whole).alias("total_tokens"),
    )
    within = Window.partitionBy("part").orderBy(F.desc("length"))
    return (
        counts.join(totals, "part")
        .withColumn("docs_at_least", F.sum("n_docs").over(within) + F.col("docs_after"))
        .withColumn("tokens_at_least", F.sum(tokens).over(within) + F.col("tokens_after"))
        .select(
            "length",
            "n_docs",
            "docs_at_least",
            "tokens_at_least",
            (F.col("total_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_total"),
            ((F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")).alias("share_at_most"),
            "total_docs",
            "total_tokens",
        )
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_cut, truncated_total) for any limits, whether or not a document has that length."""
    sums = []
    for i, limit in enumerate(limits):
        sums.append(F.sum(F.when(F.col("length") > limit, F.col("n_docs")).otherwise(0)).alias(f"cut{i}"))
        sums.append(F.sum(F.least(F.col("length"), F.lit(limit)) * F.col("n_docs")).alias(f"total{i}"))
    pairs = [F.struct(F.lit(x).alias("context_limit"), F.col(f"cut{i}").alias("docs_cut"), F.col(f"total{i}").alias("truncated_total")) for i, x in enumerate(limits)]
    return histogram.agg(*sums).select(F.inline(F.array(*pairs)))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of all documents does not exceed."""
    picks = [F.min(F.when(F.col("share_at_most") >= s, F.col("length"))).alias(f"q{i}") for i, s in enumerate(shares)]
    pairs = [F.struct(F.lit(s).alias("share"), F.col(f"q{i}").alias("length")) for i, s in enumerate(shares)]
    return histogram.agg(*picks).select(F.inline(F.array(*pairs)))
