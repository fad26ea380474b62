"""Line dedup with a log-template tree of fixed depth.

A line's place in the tree is its number of tokens and its first ``DEPTH`` tokens; tokens that hold a digit count as
the variable field ``<*>``. Two lines of one leaf are similar if they agree literally in at least ``SIMILAR`` of their
tokens; a variable place agrees with nothing. A line's template is its text with those places variable in which lines
similar to it differ from it. A template recurs if its line and the lines similar to it stand in at least ``MIN_DOCS``
documents together; the line is then dropped from all documents but the one with the least id among these.

Similarity is a property of two lines and of nothing else, so what is dropped depends on no order and on no cut of a
leaf. It is not carried on from line to line: in a family whose lines drift, each line is judged by those similar to it.

How it runs: the scan turns lines into hashes (leaf, masked line); equal lines are summed before anything is compared.
Of a line's documents only the ``MIN_DOCS`` least ids are needed, and those of several lines merge to the least of all.
Only leaves with enough lines and with several different masked lines are compared, in blocks of bounded size: a task
takes two blocks and returns for each line the least ids of those similar to it, never pairs. A leaf of very many lines
is first cut by its tokens: two similar lines differ in at most k places, so of k + 1 runs of places one agrees, and only
lines with an equal run are compared. Which lines go is joined back to the documents by id.

Defined results: null and empty texts stay; blank lines are never dropped; a null id keeps its text and is not counted;
rows that repeat an id count as one document and lose the same lines; ties do not arise, as no line is dealt to one of
several templates; very long texts and lines are taken whole; an empty table gives no rows; all columns stay, but for
earlier ones with the names of those added (``prefix`` and ``n_lines``, ``n_dropped``) and ``_masked``, ``_gone_id``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelwise.llm.common import blocks, frozen, sifted, starts
from parcelwise.llm.components import spread_join

DEPTH, SIMILAR, MIN_DOCS = 3, 0.7, 3
#: Different masked lines, and characters of them, in one block of a leaf; a task holds two blocks.
BLOCK_LINES, BLOCK_CHARS = 1024, 4 << 20
FIELD = "<*>"
_DIGIT = re.compile(rb"[0-9]").search


def parsed(texts: pa.Array, depth: int = DEPTH, texts_of: dict[int, bytes] | None = None) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The lines of each text, and every line's leaf and masked hash (0 and 0 for blank lines).

    ``texts_of`` collects the masked text of each hash. One split and two hashes a line are all it takes, which is
    several times cheaper here than kernels over all tokens.
    """
    import xxhash

    hashed, lines, leaves, masked = xxhash.xxh3_64_intdigest, [], [], []
    for text in texts.cast(pa.large_binary()).to_pylist():
        own = (text or b"").split(b"\n")
        lines.append(own)
        for line in own:
            tokens = line.split()
            if not tokens:
                leaves.append(0)
                masked.append(0)
                continue
            if _DIGIT(line):
                tokens = [FIELD.encode() if _DIGIT(t) else t for t in tokens]
            whole = b" ".join(tokens)
            leaves.append(hashed(b"%d %b" % (len(tokens), b" ".join(tokens[:depth]))))
            masked.append(hashed(whole))
            if texts_of is not None:
                texts_of.setdefault(masked[-1], whole)
    return lines, np.array(leaves, np.uint64).view(np.int64), np.array(masked, np.uint64).view(np.int64)


def lines_of(docs: DataFrame, id_col: str, text_col: str, depth: int) -> DataFrame:
    """(id, leaf, masked) of every line that is not blank, equal lines of a document once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            lines, leaf, masked = parsed(block.column("text"), depth)
            owner = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
            order = np.lexsort((masked, leaf, owner))
            owner, leaf, masked = owner[order], leaf[order], masked[order]
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (leaf[1:] != leaf[:-1]) | (masked[1:] != masked[:-1])
            new &= (leaf != 0) | (masked != 0)
            yield pa.RecordBatch.from_arrays([block.column("id").take(pa.array(owner[new])), pa.array(leaf[new]), pa.array(masked[new])], ["id", "leaf", "masked"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, leaf long, masked long")


def masked_lines(docs: DataFrame, text_col: str, depth: int) -> DataFrame:
    """(leaf, masked, line) of the different lines of every block, variable tokens masked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            texts_of: dict[int, bytes] = {}
            _, leaf, masked = parsed(block.column("text"), depth, texts_of)
            _, first = np.unique(masked, return_index=True)
            first = first[masked[first] != 0]
            text = [texts_of[m].decode() for m in masked[first].view(np.uint64).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(leaf[first]), pa.array(masked[first]), pa.array(text, pa.string())], ["leaf", "masked", "line"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "leaf long, masked long, line string")


def compared(lines: pa.Array, block: np.ndarray, similar: float = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """For lines of one width: which are similar (a square table, each with itself), and in which places each agrees
    literally with all similar ones. Lines of two blocks are compared across only, those of one block with each other."""
    coded = pc.split_pattern(lines, " ").flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).reshape(len(lines), -1)
    field = pc.index(coded.dictionary, pa.scalar(FIELD, coded.dictionary.type)).as_py()
    literal, near = codes != field, np.eye(len(lines), dtype=bool)
    agreed, width = literal.copy(), max(1, codes.shape[1])
    left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    for a in left.tolist():
        same = (codes[right] == codes[a]) & literal[a]
        hits = same.sum(axis=1) / width >= similar
        others = right[hits]
        near[a, others] = near[others, a] = True
        agreed[a] &= same[hits].all(axis=0)
        agreed[others] &= same[hits]
    return near, agreed


def generalise(lines: list[list[str]], similar: float = SIMILAR) -> tuple[list[list[str]], list[int]]:
    """The different templates of one leaf's lines, and which of them each line has."""
    if not lines:
        return [], []
    _, agreed = compared(pa.array([" ".join(x) for x in lines]), np.zeros(len(lines), np.int64), similar)
    found: dict[tuple, int] = {}
    owner = [found.setdefault(tuple(np.where(keep, line, FIELD).tolist()), len(found)) for keep, line in zip(agreed, lines, strict=True)]
    return [list(t) for t in found], owner


def _in_blocks(rows: DataFrame, key: str, total: int, block_lines: int) -> DataFrame:
    """Rows with the number of blocks ``n_blocks`` of their key's lines, keys of a single line left out."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("line")).alias("chars")).filter("n > 1")
    n_blocks = F.ceil(F.greatest(F.col("n") / block_lines, F.col("chars") / BLOCK_CHARS)).cast("int")
    return spread_join(rows, counts.select(key, "n", n_blocks.alias("n_blocks")), key, total)


def templates_of(lines: DataFrame, similar: float = SIMILAR, min_docs: int = MIN_DOCS, depth: int = DEPTH, block_lines: int = BLOCK_LINES) -> DataFrame:
    """(masked, ids, template) for (leaf, masked, line, ids), the ids of a line's documents in order, at most ``min_docs``:
    the least of all ids of the lines similar to it, and its template."""
    kind = lines.schema["ids"].dataType.simpleString()

    def compare(group: pa.Table) -> pa.Table:
        ids, text = group.column("ids").to_pylist(), group.column("line").combine_chunks()
        near, agreed = compared(text, group.column("block").to_numpy(), similar)
        names = sorted({i for own in ids for i in own})
        place = {i: k for k, i in enumerate(names)}
        ranks = np.full((len(ids), min_docs), len(names))
        for row, own in zip(ranks, ids, strict=True):
            row[: len(own)] = [place[i] for i in own]
        least = [[names[k] for k in np.unique(ranks[others])[:min_docs].tolist() if k < len(names)] for others in near]
        found = [" ".join(np.where(keep, line.split(" "), FIELD).tolist()) for keep, line in zip(agreed, text.to_pylist(), strict=True)]
        return pa.table({"masked": group.column("masked"), "ids": pa.array(least, group.schema.field("ids").type), "template": pa.array(found, pa.string())})

    total = lines.count()
    sized = _in_blocks(lines, "leaf", total, block_lines)
    # Of so many runs of places one agrees in two similar lines; a run with a variable place agrees with none.
    tokens, width = F.split("line", " "), F.size(F.split("line", " "))
    runs = F.floor(width * (1 - similar) + 1e-6).cast("int") + 1
    cut = (F.col("n_blocks") > runs) & (width - depth >= runs)
    sized = sized.withColumns({"runs": F.when(cut, runs), "width": width - depth})
    edge = lambda r: F.floor(r * F.col("width") / F.col("runs")).cast("int")
    apart = sized.filter("runs is not null").withColumn("run", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)))
    apart = apart.withColumn("own", F.slice(tokens, edge(F.col("run")) + depth + 1, edge(F.col("run") + 1) - edge(F.col("run"))))
    apart = apart.filter(~F.array_contains("own", FIELD)).select(F.xxhash64("leaf", "run", "own").alias("group"), "masked", "line", "ids")
    whole = sized.filter("runs is null").select(F.col("leaf").alias("group"), "masked", "line", "ids", "n_blocks")
    dealt = whole.unionByName(_in_blocks(apart, "group", total, block_lines)).withColumn("block", F.pmod(F.xxhash64(F.lit(7), "masked"), "n_blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    dealt = dealt.select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "masked", "line", "ids")
    found = dealt.groupBy("group", "i", "j").applyInArrow(compare, f"masked long, ids {kind}, template string")
    found = found.unionByName(lines.select("masked", "ids", F.col("line").alias("template")))
    least = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))), 1, min_docs)
    both = lambda a, b: F.zip_with(a, b, lambda x, y: F.when(x == y, x).otherwise(FIELD))
    template = F.collect_set(F.split("template", " "))
    found = found.groupBy("masked").agg(least.alias("ids"), template.alias("t"))
    return found.select("masked", "ids", F.array_join(F.reduce(F.slice("t", 2, F.size("t")), F.col("t")[0], both), " ").alias("template"))


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, similar: float = SIMILAR, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, masked) of the lines to drop. The text of a masked line tells its leaf, so its hash alone is the key."""
    lines = frozen(lines_of(docs, id_col, text_col, depth))
    counts = frozen(lines.groupBy("leaf", "masked").agg(F.count(F.lit(1)).alias("n")))
    leaves = counts.groupBy("leaf").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("kinds")).filter(F.col("rows") >= min_docs)
    kinds = frozen(spread_join(counts, leaves.withColumn("k", F.col("kinds")), "leaf", counts.count(), "k"))
    held = frozen(spread_join(lines.select("id", "masked"), kinds.select("masked", "n"), "masked", lines.count()).distinct())
    # The least ids of each line; the limit holds before the shuffle too, so a very common line sends few rows.
    order = F.row_number().over(Window.partitionBy("masked").orderBy("id"))
    least = held.withColumn("rn", order).filter(F.col("rn") <= min_docs).groupBy("masked").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    least = frozen(kinds.join(least, "masked"))
    several = least.filter("kinds > 1").select("leaf", "masked", "ids")
    texts = sifted(masked_lines(docs, text_col, depth).select("masked", "line"), several, {"masked": "masked"}, "maybe").filter("maybe")
    texts = frozen(texts.groupBy("masked").agg(F.min("line").alias("line")).join(several, "masked"))  # its scan parses every line
    found = templates_of(texts, similar, min_docs, depth).join(least.select("masked", "n"), "masked")
    often = least.filter("kinds = 1").select("masked", "ids", "n").unionByName(found.select("masked", "ids", "n"))
    often = frozen(often.filter(F.size("ids") >= min_docs).select("masked", F.col("ids")[0].alias("keeper"), "n"))
    return spread_join(held, often, "masked", held.count()).filter(F.col("id") != F.col("keeper")).select("id", "masked")


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, similar: float = SIMILAR, min_docs: int = MIN_DOCS, prefix: str = "") -> DataFrame:
    """The documents without recurring lines, with all their columns and, after ``prefix``, ``n_lines`` and ``n_dropped``."""
    added = [f"{prefix}n_lines", f"{prefix}n_dropped"]
    docs = docs.drop(*added, "_masked", "_gone_id")
    gone = recurring_lines(docs, id_col, text_col, depth, similar, min_docs)
    gone = gone.groupBy("id").agg(F.collect_set("masked").alias("_masked"))
    joined = docs.join(gone.withColumnRenamed("id", "_gone_id"), docs[id_col] == F.col("_gone_id"), "left").drop("_gone_id")
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, text_col):
            texts = block.column(where)
            text_list, drops = texts.to_pylist(), block.column("_masked").is_valid().to_numpy(zero_copy_only=False)
            n_lines = [(t or "").count("\n") + 1 for t in text_list]
            dropped = [0] * block.num_rows
            touched = np.flatnonzero(drops)  # only these are parsed again
            lines, _, masked = parsed(texts.take(pa.array(touched)), depth)
            at = starts(np.array([len(x) for x in lines], np.int64))
            bad_lines = block.column("_masked").take(pa.array(touched)).to_pylist()
            for k, i in enumerate(touched.tolist()):
                bad, own = set(bad_lines[k]), slice(at[k], at[k + 1])
                keep = [x not in bad for x in masked[own].tolist()]
                dropped[i] = len(keep) - sum(keep)
                text_list[i] = b"\n".join(x for x, k_ in zip(lines[k], keep, strict=True) if k_).decode()
            columns = block.columns[: len(docs_columns)]
            columns[where] = pa.array(text_list, texts.type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(dropped, pa.int64())], [*docs_columns, *added])

    docs_columns = docs.columns
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in added]])
    return joined.mapInArrow(run, schema)
