"""From raw documents to training token ids: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
stage's input. All but the last return the columns of ``documents``, with further ones that the table has (whatever
their names) unchanged.

Defined results: null and empty texts are judged by the classifier as empty texts, hold no lines, shingles or benchmark
words, and are encoded as no ids; a null id keeps its row. Rows that repeat id and text count as copies, of which one
stays; rows that repeat an id with another text are documents of their own. Very long texts are worked on whole. An empty
table gives no rows. ``n_chars`` is counted again for texts that lose lines, if the table has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import bpe, decontaminate, partenum, quality, templates
from parcelwise.llm.common import frozen


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    judged = quality.judge_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), prefix="__quality_")
    return judged.filter("__quality_keep").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; one that has only such lines goes."""
    kept = templates.drop_recurring_lines(docs, prefix="__lines_")
    changed = F.col("__lines_n_dropped") > 0
    kept = kept.filter(~changed | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (Jaccard of five-word shingles 0.8 or more), the one with the least id."""
    return partenum.keep_one(docs, n=5, percent=80).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids of every document, and digests of its ids and of the text they decode to."""
    return bpe.encode_and_decode(docs, digests=True)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark),
    ("BPE encoding and decoding", encode),
]

#: SQL can state neither the fitted classifier nor BPE. The tests hold lines, near copies and benchmark passages against
#: brute-force versions, the classifier's shrinkage against plain sums, and ids against the tokenizers library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = frozen(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
