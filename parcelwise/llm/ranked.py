"""Ranked lexical search: the best documents of every benchmark item, by a dual-tree search that is exact.

A first pass counts, where texts are scanned, how often each document holds each of the items' terms, and writes these
short vectors; the statistics of the corpus (documents, terms, and documents with each term) are sums over them. A
document's coordinate for a term is what one occurrence of the term in an item is worth there, an item's coordinate is
weight times repeats, so a score is an inner product.

Both sides are kept as trees. A node of the item tree holds the maximum of its items' coordinates and the weakest of
their k-th best scores so far; a node of the document tree, built over a block of documents that share heavy terms, the
maximum of theirs. The product of two nodes' maxima bounds the score of every pair below them: where it is under the
weakest k-th score, the whole batch of pairs is dropped. Pairs of leaves that stay are scored exactly.

The k-th scores begin with those that one in SEED documents reach, found by the same search, which is a lower bound for the
whole table; so tasks keep, and send on, few candidates an item beyond its k best. Those are merged in two levels.

What is broadcast, and a task's dense rows of coordinates, are bounded whatever the benchmark is: texts are scanned once
for each PASS_BYTES of item texts (whose terms a task then knows), and the short vectors searched once for each group of
about GROUP_ITEMS items and GROUP_BYTES of text, in blocks of CELLS coordinates.

Defined results: null and empty texts, and those without terms, rank nowhere and have no rank; an item that meets no
document has no rows; documents that repeat, with or without their id, each take a rank; equal scores are ranked by
ascending id, null ids last, and rows equal in both in any order, which shows in no column; an item that repeats is
ranked once for each of its rows; very long texts are searched whole; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import ALNUM, blocks, frozen, starts, strings, words

#: Documents that an item gets; one in so many documents seeds the k-th scores.
K, SEED = 10, 32
#: Bytes of item texts in a pass over the documents; bytes and items of a group that is searched together.
PASS_BYTES, GROUP_BYTES, GROUP_ITEMS = 8 << 20, 1 << 17, 512
#: Coordinates of a block of documents; documents and items of a leaf, children of a node.
CELLS, DOC_LEAF, ITEM_LEAF, CHILDREN = 1 << 23, 8, 4, 4
#: Integers up to here are exact in doubles, in which products of whole batches are taken.
EXACT = 1 << 53


def coordinates(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What an occurrence in an item is worth, for counts ``tf`` in documents of ``n`` terms."""
    if n_terms and len(n) and 75 * int(n.max()) * n_docs < 1 << 63:
        m = 25 + (75 * n * n_docs) // n_terms
    else:  # beyond 64 bits
        m = np.array([25 + (75 * int(x) * n_docs) // max(n_terms, 1) for x in n.tolist()], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def levels_of(leaves: np.ndarray) -> list[np.ndarray]:
    """Maxima of nodes, from the root's level down to the leaves; a node has CHILDREN children, which are neighbours."""
    levels = [leaves]
    while len(levels[0]) > 1:
        below = levels[0]
        levels.insert(0, np.maximum.reduceat(below, np.arange(0, len(below), CHILDREN), axis=0))
    return levels


class Items:
    """A group of items (number, text) and the tree over them. ``vocabulary`` are the terms of the pass that it belongs to,
    ``terms`` those of the group as places in it."""

    def __init__(self, rows: list[tuple[int, str | None]], vocabulary: pa.Array) -> None:
        codes, counts, distinct = words(strings(pa.array([r[1] for r in rows], pa.string())), ALNUM)
        self.numbers = [r[0] for r in rows]
        place = pc.index_in(distinct.cast(pa.large_string()), vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.terms, local = np.unique(place[codes], return_inverse=True)
        self.repeats = np.zeros((len(rows), len(self.terms)), np.int64)
        np.add.at(self.repeats, (np.repeat(np.arange(len(rows)), counts), local), 1)

    def weighted(self, weights: np.ndarray) -> None:
        """Builds the tree, given the weights of all terms of the pass: items are ordered by their heaviest terms, so that leaves
        are alike."""
        heavy = self.repeats * weights[self.terms]
        top = np.argsort(-heavy, axis=1, kind="stable")[:, :3]
        self.order = np.lexsort(top.T[::-1]) if top.size else np.arange(len(heavy))
        self.heavy = heavy[self.order].astype(float)
        n = len(self.order)
        self.leaf_at = np.append(np.arange(0, n, ITEM_LEAF), n)
        self.levels = levels_of(np.maximum.reduceat(self.heavy, self.leaf_at[:-1], axis=0)) if n else []
        self.exact = int(heavy.sum(axis=1).max(initial=0)) * 1_000_000 < EXACT


class Best:
    """The k best (score, id) of every item so far, with null ids last; ``least`` are the scores that a newcomer has to reach."""

    def __init__(self, k: int, least: np.ndarray) -> None:
        self.k, self.least, self.given = k, least.copy(), least
        self.item, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)

    def take(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        item, score, ids = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.id, ids)))
        null = np.array([x is None for x in ids], bool)
        rank = np.zeros(len(ids), np.int64)
        known = np.flatnonzero(~null)
        rank[known] = np.unique(ids[known], return_inverse=True)[1] if len(known) else 0
        order = np.lexsort((rank, null, -score, item))
        item, score, ids = item[order], score[order], ids[order]
        place = np.arange(len(item)) - np.searchsorted(item, item, side="left")
        kept = place < self.k
        self.item, self.score, self.id = item[kept], score[kept], ids[kept]
        full = place == self.k - 1
        self.least = self.given.copy()
        self.least[item[full]] = np.maximum(self.least[item[full]], score[full])


def document_tree(order_by: np.ndarray, owner: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(order, rows, levels): documents ordered so that neighbours share their heaviest term, their dense coordinates in that
    order, and the maxima of the nodes over them."""
    order = np.argsort(order_by, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    dense = np.zeros((n, width))
    dense[place[owner], term] = value
    return order, dense, levels_of(np.maximum.reduceat(dense, np.arange(0, n, DOC_LEAF), axis=0))


def search_block(items: Items, best: Best, ids: np.ndarray, owner: np.ndarray, term: np.ndarray, value: np.ndarray) -> int:
    """Takes the pairs of this block that may be among the best, descending both trees together; returns how many pairs it
    scored."""
    n, width = len(ids), len(items.terms)
    if not n or not len(items.order) or not len(term):
        return 0
    weight = items.heavy.max(axis=0)[term] * value
    first = np.full(n, width, np.int64)
    by_weight = np.lexsort((weight, owner))
    last = np.flatnonzero(np.append(np.diff(owner[by_weight]) != 0, True))
    first[owner[by_weight][last]] = term[by_weight][last]
    order, dense, doc_levels = document_tree(first, owner, term, value, n, width)
    least = best.least[items.order]
    weakest = [np.minimum.reduceat(least, items.leaf_at[:-1])]
    for _ in items.levels[:-1]:
        weakest.insert(0, np.minimum.reduceat(weakest[0], np.arange(0, len(weakest[0]), CHILDREN)))
    depth = max(len(items.levels), len(doc_levels))
    at_item = [max(0, k - depth + len(items.levels)) for k in range(depth)]
    at_doc = [max(0, k - depth + len(doc_levels)) for k in range(depth)]
    alive = np.ones((1, 1), bool)
    for k in range(depth):
        upper, lower = items.levels[at_item[k]], doc_levels[at_doc[k]]
        if k:  # the children of the pairs that are left; a tree that is not as deep waits at its root
            if at_item[k] > at_item[k - 1]:
                alive = np.repeat(alive, CHILDREN, axis=0)[: len(upper)]
            if at_doc[k] > at_doc[k - 1]:
                alive = np.repeat(alive, CHILDREN, axis=1)[:, : len(lower)]
        rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            return 0
        bound = upper[rows] @ lower[columns].T
        kept = bound * (1 + 1e-9) + 1 >= weakest[at_item[k]][rows][:, None]  # sums of maxima may be rounded
        kept &= bound > 0
        alive[np.ix_(rows, columns)] &= kept
    found_item, found_doc, found_score, scored = [], [], [], 0
    for leaf in np.flatnonzero(alive.any(axis=1)).tolist():
        a, b = items.leaf_at[leaf], items.leaf_at[leaf + 1]
        docs = (np.flatnonzero(alive[leaf])[:, None] * DOC_LEAF + np.arange(DOC_LEAF)).ravel()
        docs = docs[docs < n]
        if items.exact:
            scores = (items.heavy[a:b] @ dense[docs].T).astype(np.int64)
        else:
            scores = items.heavy[a:b].astype(np.int64) @ dense[docs].astype(np.int64).T
        scored += scores.size
        i, d = np.nonzero((scores >= best.least[items.order[a:b]][:, None]) & (scores > 0))
        found_item.append(items.order[a:b][i])
        found_doc.append(order[docs[d]])
        found_score.append(scores[i, d])
    if found_item:
        best.take(np.concatenate(found_item), np.concatenate(found_score), ids[np.concatenate(found_doc)])
    return scored


def _passes(benchmark: DataFrame, item_col: str, text_col: str, pass_bytes: int) -> tuple[DataFrame, Iterator[list[tuple[int, str | None]]]]:
    """The items numbered, and those of each pass, brought to the driver when it is its turn."""
    items = frozen(benchmark.select(F.monotonically_increasing_id().alias("number"), F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")))
    n = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // pass_bytes))
    part = F.pmod(F.xxhash64("number"), F.lit(n))
    return items, ([tuple(r) for r in items.filter(part == k).select("number", "text").collect()] for k in range(n))


def _groups(rows: list[tuple[int, str | None]], group_bytes: int, group_items: int) -> Iterator[list[tuple[int, str | None]]]:
    group, size = [], 0
    for number, text in rows:
        if group and (size + len(text or "") > group_bytes or len(group) == group_items):
            yield group
            group, size = [], 0
        group.append((number, text))
        size += len(text or "")
    if group:
        yield group


def vectors(docs: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, counts) of every document with at least one term: all its terms counted, and how often it holds each term
    of a broadcast vocabulary, by its place there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        width = len(known)
        for block in blocks(batches, "text"):
            codes, counts, distinct = words(strings(block.column("text")), ALNUM)
            slot = pc.index_in(distinct.cast(pa.large_string()), known) if width else pa.nulls(len(distinct), pa.int32())
            slot = slot.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(counts)), counts)
            term = slot[codes]
            ours = term >= 0
            key, tf = np.unique(owner[ours] * max(width, 1) + term[ours], return_counts=True)
            held = np.bincount(key // max(width, 1), minlength=len(counts))
            at = pa.array(starts(held).astype(np.int32))
            some = pa.array(counts > 0)
            columns = [block.column("id"), pa.array(counts), pa.ListArray.from_arrays(at, pa.array((key % max(width, 1)).astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(tf.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "counts"]).filter(some)

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(count, f"id {kind}, n long, terms array<int>, counts array<int>")


def search(rows: DataFrame, shared, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(number, part, score, id): the k best of each task for every item, if they reach the least scores given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least = shared.value
        best, width = Best(k, least), len(items.terms)
        step = max(DOC_LEAF, CELLS // max(width, 1))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                terms, counts = part.column("terms"), part.column("counts")
                held = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
                owner, term = np.repeat(np.arange(part.num_rows), held), terms.flatten().to_numpy().astype(np.int64)
                local = np.minimum(np.searchsorted(items.terms, term), max(width - 1, 0))
                ours = items.terms[local] == term if width else np.zeros(len(term), bool)
                owner, local, tf = owner[ours], local[ours], counts.flatten().to_numpy().astype(np.int64)[ours]
                value = coordinates(tf, part.column("n").to_numpy().astype(np.int64)[owner], n_docs, n_terms)
                search_block(items, best, np.array(part.column("id").to_pylist(), object), owner, local, value)
        task = TaskContext.get().partitionId()
        columns = [pa.array([items.numbers[i] for i in best.item], pa.int64()), pa.array([task] * len(best.item), pa.int32()), pa.array(best.score), pa.array(best.id.tolist(), kind)]
        yield pa.RecordBatch.from_arrays(columns, ["number", "part", "score", "id"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(rows.schema["id"].dataType)
    return rows.mapInArrow(run, f"number long, part int, score long, id {rows.schema['id'].dataType.simpleString()}")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, of some parts first and then of all."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    some = Window.partitionBy("number", F.pmod("part", F.lit(64))).orderBy(*order)
    found = found.withColumn("_r", F.row_number().over(some)).filter(F.col("_r") <= k).drop("_r")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))).filter(F.col("rank") <= k).drop("part")


def rank_documents(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    k: int = K, seed: int = SEED, pass_bytes: int = PASS_BYTES, group_bytes: int = GROUP_BYTES, group_items: int = GROUP_ITEMS,
) -> DataFrame:
    """(item, rank, id, score): the ``k`` highest-scoring documents of every item."""
    spark = docs.sparkSession
    items, passes = _passes(benchmark, item_col, item_text_col, pass_bytes)
    found = None
    for group in passes:
        vocabulary = words(strings(pa.array([r[1] for r in group], pa.string())), ALNUM)[2].cast(pa.large_string())
        shared = spark.sparkContext.broadcast(vocabulary)
        rows = frozen(vectors(docs, shared, id_col, text_col))
        shared.destroy()
        total = rows.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        n_docs, n_terms = total["docs"], total["terms"]
        df = np.zeros(len(vocabulary), np.int64)
        for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():  # a row for each term of the pass
            df[r["term"]] = r["df"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        for some in _groups(group, group_bytes, group_items):
            known = Items(some, vocabulary)
            known.weighted(weights)
            least = np.ones(len(some), np.int64)
            if seed:
                shared = spark.sparkContext.broadcast((known, least))
                sample = rows.filter(F.pmod(F.xxhash64("id", "n", "terms"), F.lit(seed)) == 0)
                reached = _best(search(sample, shared, n_docs, n_terms, k), k).filter(F.col("rank") == k).select("number", "score").collect()  # a row for each item
                place = {number: i for i, number in enumerate(known.numbers)}
                for r in reached:
                    least[place[r["number"]]] = r["score"]
                shared.destroy()
            shared = spark.sparkContext.broadcast((known, least))
            one = frozen(_best(search(rows, shared, n_docs, n_terms, k), k))
            shared.destroy()
            found = one if found is None else found.unionByName(one)
    if found is None:
        kind = docs.schema[id_col].dataType.simpleString()
        found = spark.createDataFrame([], f"number long, score long, id {kind}, rank int")
    named = found.join(items.select(F.col("number").alias("_number"), "item"), F.col("number") == F.col("_number"))
    return named.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
