"""Approximate nearest neighbours with an inverted multi-index (Babenko, Lempitsky 2012).

Both halves of the vectors are quantised separately, so K centroids each make K x K cells. A query takes cells in the
order of the sum of its two halves' distances to their centroids, by a heap over the two sorted lists of centroids,
until enough vectors lie in them; those are ranked again by their exact inner product. The distance of a half is how
much less its inner product with a centroid is than with the best centroid.

How many vectors are enough is measured when the index is fitted: the smallest share of all vectors at which sample
queries find ``RECALL`` of their true neighbours in the sample. Vectors without structure need a large share, and
clustered ones a small one. The fit uses a bounded sample (``SAMPLE`` vectors); every vector is indexed.

How it runs: the vectors that take part are written once with a key for each row. Entries are dealt by their first
centroid, in salted blocks of bounded size; a query goes once to each row of cells it visits, with the set of cells
there. Each task multiplies a block of queries with a block of entries and keeps the nearest of each query; these are
merged by query and row of cells first, and by query then. K grows with the square root of the number of vectors up to
``MOST_CENTROIDS``; only cell counts (K x K numbers) and the sample reach the driver.

Defined results: vectors that are null, zero, hold null or non-finite components, or are not as long as most take no
part, as do rows without id. Every row is a vector of its own: rows that repeat an id, or id and vector, are all
candidates, a query leaves out its own row alone, and each query row has its own list under its id. Equal scores go by
the smaller id; a query with fewer candidates gets all; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import frozen

#: Cells hold about PER_CELL vectors, with LEAST_CENTROIDS to MOST_CENTROIDS centroids for each half.
PER_CELL, LEAST_CENTROIDS, MOST_CENTROIDS = 50, 16, 256
SAMPLE, RECALL = 8192, 0.96
#: Entries and queries in one task.
ENTRIES, QUERIES = 8192, 16_384


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that take part, v in double precision."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(fine).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    length = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("k"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (length[0]["n"] if length else -1))


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of the rows, from evenly spread first rows of a fixed order."""
    k = min(k, len(x))
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * x @ centres.T, axis=1)


@dataclass
class Index:
    first: np.ndarray
    second: np.ndarray
    share: float = 1.0

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(x[:, : self.half], self.first), nearest(x[:, self.half :], self.second)

    def distances(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.first @ q[: self.half], self.second @ q[self.half :]
        return a.max() - a, b.max() - b

    def visit(self, q: np.ndarray, counts: np.ndarray, enough: float) -> list[tuple[int, int]]:
        """Cells in the order of summed distance, until ``enough`` vectors lie in them."""
        a, b = self.distances(q)
        rows, columns = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
        a, b = a[rows].tolist(), b[columns].tolist()
        heap, out, got = [(a[0] + b[0], 0, 0)], [], 0
        upto = [0] * len(rows)  # columns taken of each row
        while heap and got < enough:
            _, i, j = heapq.heappop(heap)
            out.append((rows[i], columns[j]))
            got += counts[rows[i], columns[j]]
            upto[i] = j + 1
            if j + 1 < len(columns) and (i == 0 or upto[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if i + 1 < len(rows) and upto[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        return out


def centroids_for(n: int) -> int:
    """Centroids of each half for ``n`` vectors."""
    return int(min(MOST_CENTROIDS, max(LEAST_CENTROIDS, round((n / PER_CELL) ** 0.5))))


def fit_index(sample: np.ndarray, top: int, centroids: int = LEAST_CENTROIDS, recall: float = RECALL, probes: int = 96) -> Index:
    """Codebooks, and the share of vectors that probes from the sample have to look at."""
    half = sample.shape[1] // 2
    index = Index(kmeans(sample[:, :half], centroids), kmeans(sample[:, half:], centroids))
    i, j = index.cells(sample)
    shares = []
    for p in np.linspace(0, len(sample) - 1, min(probes, len(sample))).astype(int):
        q = sample[p]
        score = sample @ q
        score[p] = -np.inf
        best = np.argsort(-score, kind="stable")[: min(top, len(sample) - 1)]
        a, b = index.distances(q)
        # A vector's turn is the number of vectors in cells no farther than its own.
        far = a[i] + b[j]
        shares += (np.searchsorted(np.sort(far), far[best], side="right") / len(sample)).tolist()
    index.share = float(np.quantile(shares, recall)) if shares else 1.0
    return index


def _stack(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def best_of(queries: np.ndarray, query_rows: np.ndarray, entries: np.ndarray, entry_rows: np.ndarray, entry_ids: np.ndarray, open_: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query position, ids, exact scores) of each query's nearest among the entries that ``open_`` lets it see."""
    with np.errstate(all="ignore"):  # products may overflow
        rough = queries @ entries.T
        # Rounding of a product, however it is summed up, by the norms and not by the product itself, which may cancel out.
        slack = 16 * queries.shape[1] * np.finfo(float).eps * np.linalg.norm(entries, axis=1)
        norms = np.linalg.norm(queries, axis=1)
    for k in range(len(queries)):
        seen = np.flatnonzero(open_[k] & (entry_rows != query_rows[k]))
        if len(seen) > top:
            near, off = rough[k][seen], slack[seen] * norms[k]
            if np.isfinite(near).all() and np.isfinite(off).all():
                seen = seen[near + off >= np.partition(near - off, -top)[-top]]
        with np.errstate(all="ignore"):
            exact = (entries[seen] * queries[k]).sum(axis=1)
        order = np.lexsort((entry_ids[seen], -exact))[:top]
        if len(order):
            yield k, entry_ids[seen][order], exact[order]


def search(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 20, centroids: int | None = None, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, id, score): the nearest found of every row that ``queries`` (a condition on ``id``) picks."""
    spark = vectors.sparkSession
    rows = frozen(usable(vectors, id_col, vector_col).withColumn("row", F.monotonically_increasing_id()).select("row", "id", "v"))
    schema = "query_id long, rank int, vec_id long, score double"
    taken = rows.orderBy(F.xxhash64("id"), "id", "row").limit(sample).select("v").toArrow()
    if not taken.num_rows:
        return spark.createDataFrame([], schema).withColumnRenamed("vec_id", id_col)
    index = spark.sparkContext.broadcast(fit_index(_stack(taken.column("v")), top, centroids or centroids_for(rows.count()), recall))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                i, j = index.value.cells(_stack(batch.column("v")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))], ["row", "id", "v", "i", "j"])

    placed = rows.mapInArrow(place, "row long, id long, v array<double>, i int, j int")
    counted = placed.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n")).collect()  # at most centroids x centroids rows
    counts = np.zeros((len(index.value.first), len(index.value.second)), np.int64)
    for r in counted:
        counts[r["i"], r["j"]] = r["n"]
    total = int(counts.sum())
    enough = max(index.value.share * total, 50 * top)
    asked = rows.filter(queries)
    n_queries = asked.count()
    parts = max(1, -(-n_queries // QUERIES))
    blocks_of_row = np.maximum(1, -(-counts.sum(axis=1) // ENTRIES)).tolist()

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, where = [], []
            x = _stack(batch.column("v")) if batch.num_rows else []
            for k, q in enumerate(x):
                seen: dict[int, list[int]] = {}
                for i, j in index.value.visit(q, counts, enough):
                    if counts[i, j]:
                        seen.setdefault(i, []).append(j)
                at += [k] * len(seen)
                where += seen.items()
            if at:
                pick = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pick) for c in ("row", "id", "v")], pa.array([i for i, _ in where], pa.int32()), pa.array([j for _, j in where], pa.list_(pa.int32())), pa.array([blocks_of_row[i] for i, _ in where], pa.int32())],
                    ["row", "id", "v", "i", "cells", "blocks"],
                )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            q_rows, e_rows, e_ids, i = (t.column(c).to_numpy() for t, c in ((left, "row"), (right, "row"), (right, "id"), (left, "i")))
            q_ids = left.column("id").to_numpy()
            q, e, j = _stack(left.column("v")), _stack(right.column("v")), right.column("j").to_numpy()
            mask = np.zeros((len(q), counts.shape[1]), bool)
            for k, cells in enumerate(left.column("cells").to_pylist()):
                mask[k, cells] = True
            for a in range(0, len(q), 512):
                part = slice(a, a + 512)
                for k, ids, scores in best_of(q[part], q_rows[part], e, e_rows, e_ids, mask[part][:, j], top):
                    out.append((int(q_rows[a + k]), int(q_ids[a + k]), int(i[a + k]), [{"s": -s, "id": x} for s, x in zip(scores.tolist(), ids.tolist(), strict=True)]))
        near = pa.list_(pa.struct([("s", pa.float64()), ("id", pa.int64())]))
        return pa.table({c: pa.array([o[k] for o in out], t) for k, (c, t) in enumerate((("row", pa.int64()), ("query_id", pa.int64()), ("i", pa.int32()), ("near", near)))})

    block_count = F.element_at(F.array(*[F.lit(b) for b in blocks_of_row]), F.col("i") + 1)
    entries = placed.withColumn("e", F.pmod(F.xxhash64("row"), block_count).cast("int")).withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    visits = asked.mapInArrow(visit, "row long, id long, v array<double>, i int, cells array<int>, blocks int")
    visits = visits.withColumn("q", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")).withColumn("e", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = visits.groupBy("i", "e", "q").cogroup(entries.groupBy("i", "e", "q")).applyInArrow(compare, "row long, query_id long, i int, near array<struct<s:double,id:bigint>>")
    nearest_of = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, top).alias("near")
    merged = met.groupBy("row", "query_id", "i").agg(nearest_of).groupBy("row", "query_id").agg(nearest_of)
    return merged.select("query_id", F.posexplode("near").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col), (-F.col("x.s")).alias("score"))
