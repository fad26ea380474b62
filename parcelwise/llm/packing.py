"""Best-fit packing by a configuration linear program over the length histogram.

Documents are encoded where they are scanned; what is longer than a sequence is cut into pieces of its length. Only the
histogram of piece lengths, of at most ``capacity`` rows, decides how sequences are filled: a configuration is a multiset
of lengths that fits one sequence, and the program asks how often to use each so that all pieces are covered by the
fewest sequences. Multiplicative weights solve it: a length's weight falls with the share of its pieces that is covered
already, and a knapsack over the weights prices configurations, one table for all lengths at once. What the fractional
solution uses of a configuration is rounded down; the pieces that this leaves are put, longest first, where they fit
best, into space that configurations leave or into new sequences, also by counts and not by pieces.

The plan has a few rows for each configuration and does not grow with the documents. Pieces of one length are
interchangeable, so a piece finds its place from its number among those of its length: counted within the task that
encoded it, plus what earlier tasks have. No length is ranked in one task.

Defined results: a null or empty text is a piece of the end id alone; repeated rows and null ids are packed like others;
texts of any length are cut whole; pieces of equal length may be swapped from run to run of another partitioning, which
changes no count; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import blocks, frozen, starts
from parcelwise.llm.tokenize import encode_texts, vocabulary_path

#: Tokens of a sequence; the id that ends a document; bytes of text in one block.
CAPACITY, END_ID, BLOCK = 4096, 1, 8 << 20
#: The program is solved in so many phases, each covering an equal share of all pieces, with so many pricings at most;
#: RATE is how fast a weight falls with what a length is ahead of its share, in phases.
PHASES, PRICINGS, RATE = 8, 6, 0.5

Configuration = tuple[tuple[int, int], ...]  # (length, copies), longest first


def price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """The knapsack table: for each room, the length (as an index into ``lengths``, ascending) that a best filling of it takes
    next, or -1 to leave one token of it free."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if k := fitting[room]:
            found = best[room - lengths[:k]] + values[:k]
            i = k - 1 - int(found[::-1].argmax())  # of equals the longest: short pieces are kept for gaps
            if found[i] > best[room]:
                best[room], choice[room] = found[i], i
    return choice


def filled(choice: np.ndarray, lengths: list[int], first: int, capacity: int) -> dict[int, int]:
    """The best configuration that holds length number ``first``, as copies by number."""
    copies, room = {first: 1}, capacity - lengths[first]
    while room > 0:
        i = int(choice[room])
        if i < 0:
            room -= 1
        else:
            copies[i] = copies.get(i, 0) + 1
            room -= lengths[i]
    return copies


def fractional(counts: dict[int, int], capacity: int = CAPACITY) -> dict[Configuration, float]:
    """How often the program uses each configuration. No length is used more often than it occurs; what stays uncovered is
    left to the rounding."""
    lengths = np.array(sorted(counts), np.int64)
    n, covered, as_list = np.array([counts[x] for x in sorted(counts)], float), np.zeros(len(counts)), sorted(counts)
    used: dict[Configuration, float] = {}
    for phase in range(1, PHASES + 1):
        due, limit = n * phase / PHASES, n * min(1, (phase + 1) / PHASES)
        for _ in range(PRICINGS):
            weights = lengths * np.exp(-RATE * np.maximum(covered / n * PHASES - phase + 1, 0))
            open_ = limit - covered > 1e-9 * n
            choice = price(lengths[open_], weights[open_], capacity)
            number = np.append(np.flatnonzero(open_), -1)  # -1 stays -1
            choice, moved = number[choice], False
            for i in range(len(as_list) - 1, -1, -1):
                need = due[i] - covered[i]
                if need <= 1e-9 * n[i]:
                    continue
                copies = filled(choice, as_list, i, capacity)
                share = min(need / copies[i], *((limit[k] - covered[k]) / c for k, c in copies.items()))
                if share <= 0:
                    continue
                for k, c in copies.items():
                    covered[k] += share * c
                key = tuple(sorted(((as_list[k], c) for k, c in copies.items()), reverse=True))
                used[key] = used.get(key, 0.0) + share
                moved = True
            if not moved:
                break
    return used


class Bins:
    """Sequences by configuration and free room, with how many there are of each."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.mask, self.at = capacity, 0, [[] for _ in range(capacity + 1)]

    def add(self, copies: dict[int, int], n: int, free: int) -> None:
        if n:
            self.at[free].append((copies, n))
            self.mask |= 1 << free

    def place(self, length: int, n: int) -> None:
        """``n`` pieces, each where the least room stays."""
        while n:
            fits = self.mask >> length
            if fits:
                free = length + (fits & -fits).bit_length() - 1
                copies, bins = self.at[free].pop()
                if not self.at[free]:
                    self.mask &= ~(1 << free)
            else:
                free, copies = self.capacity, {}
                bins = -(-n // (free // length))
            each = min(free // length, n)
            taken = min(bins, n // each)
            self.add(copies, bins - taken, free)
            self.add({**copies, length: copies.get(length, 0) + each}, taken, free - each * length)
            n -= taken * each

    def all(self) -> Iterator[tuple[Configuration, int]]:
        for groups in self.at:
            for copies, n in groups:
                if copies:
                    yield tuple(sorted(copies.items(), reverse=True)), n


def configurations(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Configuration, int]]:
    """Configurations that hold exactly these pieces, and how many sequences are filled by each."""
    bins, left = Bins(capacity), {x: n for x, n in counts.items() if n and x < capacity}
    for configuration, share in fractional(left, capacity).items() if left else ():
        n = int(share + 1e-9)
        n = min(n, *(left[x] // c for x, c in configuration))
        if n > 0:
            bins.add(dict(configuration), n, capacity - sum(x * c for x, c in configuration))
            for x, c in configuration:
                left[x] -= n * c
    for length in sorted(left, reverse=True):
        bins.place(length, left[length])
    full = [(((capacity, 1),), counts[capacity])] if counts.get(capacity) else []
    return full + list(bins.all())


class Plan:
    """Places of pieces by length and number, as rows of (length, first number, copies in a sequence, first sequence, offset)."""

    def __init__(self, configured: list[tuple[Configuration, int]]) -> None:
        rows, seen, sequence = [], {}, 0
        for configuration, n in configured:
            offset = 0
            for length, copies in configuration:
                rows.append((length, seen.get(length, 0), copies, sequence, offset))
                seen[length] = seen.get(length, 0) + n * copies
                offset += length * copies
            sequence += n
        self.sequences, self.wide = sequence, max(seen.values(), default=0) + 1
        self.length, self.first, self.copies, self.sequence, self.offset = np.array(sorted(rows), np.int64).reshape(-1, 5).T
        self.key = self.length * self.wide + self.first

    def places(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces."""
        row = np.searchsorted(self.key, length * self.wide + number, side="right") - 1
        within = number - self.first[row]
        return self.sequence[row] + within // self.copies[row], self.offset[row] + within % self.copies[row] * length


def numbered(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Each piece's number among those of its length, after the ``seen`` ones, which are counted on."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    first = np.searchsorted(ordered, ordered, side="left")
    out = np.empty(len(lengths), np.int64)
    out[order] = seen[ordered] + np.arange(len(lengths)) - first
    np.add.at(seen, lengths, 1)
    return out


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "word_bpe_49k.json", end_id: int = END_ID, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, number) of all pieces, and their ``ids`` with ``keep_ids``. ``number`` counts
    pieces of one length in one task."""
    path = vocabulary_path(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, task = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for block in blocks(batches, "text", BLOCK):
            ids, counts = encode_texts(path, block.column("text"))
            ends = starts(counts)[1:]
            ids = np.insert(ids, ends, end_id).astype("<u4")
            counts = counts + 1
            at, per = starts(counts), -(-counts // capacity)
            owner = np.repeat(np.arange(len(counts)), per)
            piece = np.arange(len(owner)) - np.repeat(starts(per)[:-1], per)
            start = piece * capacity
            length = np.minimum(capacity, counts[owner] - start)
            low = at[:-1][owner] + start
            data = memoryview(ids.tobytes())
            columns = {
                "id": block.column("id").take(pa.array(owner)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start), "length": pa.array(length),
                "ids_crc32": pa.array([zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(low.tolist(), length.tolist(), strict=True)], pa.int64()),
                "task": pa.array(np.full(len(owner), task), pa.int32()), "number": pa.array(numbered(length, seen)),
            }
            if keep_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(low, len(ids)), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(cut, f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, number long" + ", ids array<int>" * keep_ids)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "word_bpe_49k.json", end_id: int = END_ID, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of all pieces of all documents, and their ``ids`` with ``keep_ids``."""
    cut = frozen(pieces(docs, id_col, text_col, vocabulary, end_id, capacity, keep_ids))
    by_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    shared = docs.sparkSession.sparkContext.broadcast(Plan(configurations(counts, capacity)))
    before = by_task.select("length", "task", (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    rows = cut.join(before, ["length", "task"]).withColumn("number", F.col("before") + F.col("number"))
    names = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = shared.value.places(length, number)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kind = cut.schema["id"].dataType.simpleString()
    out = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids + ", sequence_id long, offset long"
    return rows.select(*names, "number").mapInArrow(place, out).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_pieces, ids): the packed sequences themselves, from pieces that kept their ids; each has at most
    ``capacity`` of them."""
    rows = packed.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("n_pieces"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return rows.select("sequence_id", "n_pieces", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
