"""Benchmark decontamination with suffix arrays over shards of the training texts.

The texts stay where they are scanned: every block of documents is a shard with its own suffix array of words, and
every suffix of every benchmark item is looked up in it by binary search. What begins with the same words lies side by
side in the array, so one search gives all places of a window, and the neighbours of a whole suffix give its longest
verbatim match. Suffixes of training text that cannot hold even the shortest window (their first words are not all
benchmark words) are left out of the array, which loses no match. Nothing is shuffled.

Every document also gets its longest verbatim match: an occurrence of a window that no earlier word extends is compared
with the benchmark suffix it begins, word by word.

The benchmark is broadcast in groups of bounded size (``GROUP_BYTES``), which are built one at a time; with more than one
group the hits of the passes are merged by document.

Defined results: null or empty texts have no words and no hits; an item without words matches nothing; equal items
each count; a null item id reads as an empty string; repeated documents stay; very long texts are searched whole; of
equally long matches the first in the text counts, then the least item id (for a benchmark suffix: the place of the least
id, null ids last, then the first word); an empty benchmark or table gives no hits or no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.common import ALNUM, blocks, starts, strings, translated

WINDOW = 10
MATCH = pa.struct([("words", pa.int64()), ("word", pa.int64()), ("item", pa.string())])
#: Bytes of benchmark text that one broadcast may hold.
GROUP_BYTES = 32 << 20


def word_array(texts: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order, and how many each text has."""
    lists = pc.split_pattern(translated(texts, ALNUM), " ")
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    real = pc.not_equal(pc.binary_length(flat), 0)
    ends = starts(real.to_numpy(zero_copy_only=False))
    return flat.filter(real), np.diff(ends[offsets])


class Benchmark:
    """The items of one group: their words as codes from 1, and their distinct windows."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        items = sorted(items)
        flat, counts = word_array(strings(pa.array([t for _, t in items], pa.large_string())))
        coded = flat.dictionary_encode()
        self.ids = [i for i, _ in items]
        self.vocabulary = coded.dictionary
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        self.item_at = starts(counts)
        self.window = window
        known: dict[bytes, int] = {}
        at, length, owners, texts = [], [], [], set()
        #: The window at each word, -1 where none begins or an equal earlier item has it.
        self.window_of = np.full(len(self.codes), -1, np.int64)
        for item, n in enumerate(counts.tolist()):
            w = min(window, n)
            whole = self.codes[self.item_at[item] : self.item_at[item + 1]].tobytes()
            new = whole not in texts
            texts.add(whole)
            for p in range(self.item_at[item], self.item_at[item] + n - w + 1 if n else 0):
                k = known.setdefault(self.codes[p : p + w].tobytes(), len(known))
                if k == len(at):
                    at.append(p)
                    length.append(w)
                    owners.append(set())
                owners[k].add(item)
                if new:
                    self.window_of[p] = k
        self.at, self.length = np.array(at, np.int64), np.array(length, np.int64)
        self.owner_n = np.array([len(o) for o in owners], np.int64)
        self.owners = np.array([i for o in owners for i in sorted(o)], np.int64)
        self.shortest = int(self.length.min()) if at else 0
        self.deepest = int(counts.max()) if len(counts) else 0


class SuffixArray:
    """Sorted suffixes of a shard. ``text`` holds benchmark codes, 0 for every other word and at each text's end."""

    def __init__(self, text: np.ndarray, shortest: int, deepest: int, n_codes: int):
        self.text = np.concatenate([text, np.zeros(deepest + 64, np.int64)])
        inside = text > 0
        edge = np.flatnonzero(~inside)
        run_end = np.searchsorted(edge, np.arange(len(text)))
        ends = np.append(edge, len(text))[run_end] if len(text) else np.zeros(0, np.int64)
        order = np.flatnonzero(inside & (ends - np.arange(len(text)) >= shortest))
        bits = max(1, int(n_codes).bit_length())
        step = 62 // bits
        group = np.zeros(len(order), np.int64)
        active = np.arange(len(order))
        for depth in range(0, max(deepest, 1), step):
            if not len(active):
                break
            key, at, whole = np.zeros(len(active), np.int64), order[active] + depth, np.ones(len(active), bool)
            for j in range(step):
                word = self.text[np.minimum(at + j, len(self.text) - 1)]
                key = (key << bits) | word
                whole &= word > 0
            rank = np.lexsort((key, group[active])) if depth else np.argsort(key, kind="stable")
            order[active] = order[active][rank]
            key, whole, own = key[rank], whole[rank], group[active]
            new = np.ones(len(active), bool)
            new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
            label = np.cumsum(new) - 1
            group[active] = label
            active = active[whole & (np.bincount(label)[label] > 1)]
        self.order = order

    def _smaller(self, place: np.ndarray, query: np.ndarray, at: np.ndarray, depth: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether the suffix in each place sorts before the query's first ``depth`` words (or equals them)."""
        pos, out, open_ = self.order[place], np.zeros(len(place), bool), np.ones(len(place), bool)
        for j in range(int(depth.max(initial=0))):
            live = np.flatnonzero(open_ & (depth > j))
            if not len(live):
                break
            a, b = self.text[pos[live] + j], query[at[live] + j]
            out[live[a < b]] = True
            open_[live[a != b]] = False
        out[open_] = or_equal
        return out

    def bound(self, query: np.ndarray, at: np.ndarray, depth: np.ndarray, upper: bool) -> np.ndarray:
        """Binary search of all queries at once."""
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(self.order), np.int64)
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                return low
            mid = (low[live] + high[live]) // 2
            right = self._smaller(mid, query, at[live], depth[live], upper)
            low[live[right]] = mid[right] + 1
            high[live[~right]] = mid[~right]

    def common(self, place: np.ndarray, query: np.ndarray, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Words that the suffix in each place shares with its query; 0 outside the array."""
        out = np.zeros(len(at), np.int64)
        live = np.flatnonzero((place >= 0) & (place < len(self.order)))
        j = 0
        while len(live):
            live = live[depth[live] > j]
            same = self.text[self.order[place[live]] + j] == query[at[live] + j]
            live = live[same]
            j += 1
            out[live] = j
        return out


def shard(texts: pa.Array, bench: Benchmark) -> tuple[SuffixArray, np.ndarray, np.ndarray]:
    """The suffix array of some texts, where each text starts in it, and how many words each has."""
    flat, counts = word_array(strings(texts))
    codes = pc.fill_null(pc.index_in(flat, bench.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    at = starts(counts + 1)
    text = np.zeros(at[-1], np.int64)
    text[np.arange(len(codes)) + np.repeat(np.arange(len(counts)), counts)] = codes
    return SuffixArray(text, bench.shortest, bench.deepest, len(bench.vocabulary)), at, counts


def longest_of(suffixes: SuffixArray, bench: Benchmark, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(text, words, first word, item) of the longest match of each text that has one; low and high bound the places of
    every window."""
    item = np.repeat(np.arange(len(bench.ids)), np.diff(bench.item_at))
    suffix = np.flatnonzero(bench.window_of >= 0)
    begin = low[bench.window_of[suffix]]
    n = high[bench.window_of[suffix]] - begin
    suffix, place = np.repeat(suffix, n), np.arange(n.sum()) + np.repeat(begin - starts(n)[:-1], n)
    extended = (suffix > bench.item_at[item[suffix]]) & (suffixes.text[suffixes.order[place] - 1] == bench.codes[suffix - 1])
    suffix, place = suffix[~extended], place[~extended]
    length = suffixes.common(place, bench.codes, suffix, bench.item_at[item[suffix] + 1] - suffix)
    text = np.searchsorted(at, suffixes.order[place], side="right") - 1
    found = np.stack([text, length, suffixes.order[place] - at[text], item[suffix]], axis=1)
    found = found[np.lexsort((found[:, 3], found[:, 2], -length, text))]
    return found[np.append(True, found[1:, 0] != found[:-1, 0])] if len(found) else found


def hits(texts: pa.Array, bench: Benchmark, with_longest: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, a mark for every word that is hit with text starts, the (text, item) pairs, and, if asked
    for, the longest matches."""
    suffixes, at, counts = shard(texts, bench)
    edges = np.zeros(at[-1] + bench.window + 1, np.int64)
    pairs, longest = np.zeros((0, 2), np.int64), np.zeros((0, 4), np.int64)
    if len(bench.at) and len(suffixes.order):
        low = suffixes.bound(bench.codes, bench.at, bench.length, False)
        high = suffixes.bound(bench.codes, bench.at, bench.length, True)
        n = high - low
        window = np.repeat(np.arange(len(n)), n)
        begin = suffixes.order[np.arange(n.sum()) + np.repeat(low - starts(n)[:-1], n)]
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + bench.length[window], -1)
        doc = np.searchsorted(at, begin, side="right") - 1
        both = np.sort(doc * len(bench.at) + window)
        both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
        doc, window = both // len(bench.at), both % len(bench.at)
        owner_at = starts(bench.owner_n)
        item = bench.owners[np.arange(bench.owner_n[window].sum()) + np.repeat(owner_at[window] - starts(bench.owner_n[window])[:-1], bench.owner_n[window])]
        pairs = np.stack([np.repeat(doc, bench.owner_n[window]), item], axis=1)
        if with_longest:
            longest = longest_of(suffixes, bench, low, high, at)
    return counts, np.cumsum(edges)[: at[-1]] > 0, at, pairs, longest


def _groups(benchmark: DataFrame, item_col: str, text_col: str, window: int, limit: int) -> tuple[int, Iterator[Benchmark]]:
    """How many groups the items make, and each of them when it is asked for."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    items = items.distinct()
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item") + 16).alias("n")).first()["n"] or 0
    n = max(1, -(-total // limit))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    own = [items if n == 1 else items.filter(part == k) for k in range(n)]
    return n, (Benchmark([(r["item"], r["text"]) for r in group.collect()], window) for group in own)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(id, n_words, spans, items, longest) of every document: hit word ranges [start, end), the items found, sorted, and
    the longest verbatim match (words, word where it starts, item), null without one."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    n_groups, groups = _groups(benchmark, item_col, item_text_col, window, group_bytes)
    many = n_groups > 1
    if many:
        picked = picked.groupBy("id", "text").agg(F.count(F.lit(1)).alias("copies"))
    else:
        picked = picked.withColumn("copies", F.lit(1).cast("long"))
    passes = []
    for group in groups:
        shared = docs.sparkSession.sparkContext.broadcast(group)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            bench = shared.value
            for block in blocks(batches, "text"):
                counts, hit, at, pairs, longest = hits(block.column("text"), bench, True)
                spans, items, match = [[] for _ in counts], [set() for _ in counts], [None] * len(counts)
                step = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                for begin, end in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True):
                    d = int(np.searchsorted(at, begin, side="right")) - 1
                    spans[d].append({"start": begin - int(at[d]), "end": end - int(at[d])})
                for d, i in pairs.tolist():
                    items[d].add(bench.ids[i])
                for d, n, word, i in longest.tolist():
                    match[d] = {"words": n, "word": word, "item": bench.ids[i]}
                yield pa.RecordBatch.from_arrays(
                    [block.column("id"), block.column("copies"), pa.array(strings(block.column("text")) if many else [None] * len(counts), pa.string()), pa.array(counts), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(match, MATCH)],
                    ["id", "copies", "text", "n_words", "spans", "items", "longest"],
                )

        passes.append(picked.mapInArrow(search, f"id {kind}, copies long, text string, n_words long, spans array<struct<start:bigint,end:bigint>>, items array<string>, longest struct<words:bigint,word:bigint,item:string>"))
    if not many:
        return passes[0].select(F.col("id").alias(id_col), "n_words", "spans", "items", "longest")
    found = passes[0]
    for other in passes[1:]:
        found = found.unionByName(other)
    found = found.groupBy("id", F.xxhash64("text").alias("t"), "n_words", "copies").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.min(F.when(F.col("longest").isNotNull(), F.struct((-F.col("longest.words")).alias("less"), F.col("longest.word"), F.col("longest.item")))).alias("m"),
    )
    longest = F.when(F.col("m").isNotNull(), F.struct((-F.col("m.less")).alias("words"), F.col("m.word"), F.col("m.item")))
    return found.select(F.col("id").alias(id_col), "n_words", merged_spans("spans").alias("spans"), "items", longest.alias("longest"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def merged_spans(column: str):
    """Ranges that overlap or touch made one, in order."""
    joined = F.aggregate(
        F.array_sort(column),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"),
        lambda done, x: F.when((F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))).cast("array<struct<start:bigint,end:bigint>>"))
        ).otherwise(F.concat(done, F.array(x))),
    )
    return F.when(F.size(column) > 0, joined).otherwise(F.col(column))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The documents that hold no window of any item, with all their columns and in one pass over them."""
    _, groups = _groups(benchmark, item_col, item_text_col, window, group_bytes)
    kept = docs
    for group in groups:
        shared = docs.sparkSession.sparkContext.broadcast(group)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches, text_col):
                _, hit, at, _, _ = hits(block.column(text_col), shared.value)
                seen = starts(hit)
                yield block.filter(pa.array(seen[at[1:]] == seen[at[:-1]]))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(item, item_word, length, id, word) for every benchmark suffix that matches at least a window somewhere.

    ``length`` is the longest verbatim match over all shards, and (id, word) one place of it: the smallest.
    """
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind, found = picked.schema["id"].dataType.simpleString(), None
    for group in _groups(benchmark, item_col, item_text_col, window, group_bytes)[1]:
        shared = docs.sparkSession.sparkContext.broadcast(group)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            bench = shared.value
            item = np.repeat(np.arange(len(bench.ids)), np.diff(bench.item_at))
            at = np.arange(len(bench.codes))
            left = bench.item_at[1:][item] - at
            need = np.minimum(bench.window, np.diff(bench.item_at)[item])
            for block in blocks(batches, "text"):
                suffixes, doc_at, _ = shard(block.column("text"), bench)
                if not len(suffixes.order) or not len(at):
                    continue
                place = suffixes.bound(bench.codes, at, left, False)
                best = np.maximum(suffixes.common(place, bench.codes, at, left), suffixes.common(place - 1, bench.codes, at, left))
                some = np.flatnonzero(best >= np.maximum(need, 1))
                low = suffixes.bound(bench.codes, at[some], best[some], False)
                high = suffixes.bound(bench.codes, at[some], best[some], True)
                ids = block.column("id").to_pylist()
                rows = []
                for k, a, b in zip(some.tolist(), low.tolist(), high.tolist(), strict=True):
                    d = np.searchsorted(doc_at, suffixes.order[a:b], side="right") - 1
                    none, first, word = min((ids[x] is None, 0 if ids[x] is None else ids[x], int(p - doc_at[x])) for x, p in zip(d.tolist(), suffixes.order[a:b].tolist(), strict=True))
                    rows.append((bench.ids[item[k]], int(k - bench.item_at[item[k]]), int(best[k]), None if none else first, word))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), block.schema.field("id").type, pa.int64()), strict=True)], ["item", "item_word", "length", "id", "word"])

        one = picked.mapInArrow(search, f"item string, item_word long, length long, id {kind}, word long")
        found = one if found is None else found.unionByName(one)
    best = F.min_by(F.struct("length", "id", "word"), F.struct(-F.col("length"), F.col("id").isNull(), "id", "word"))
    return found.groupBy("item", "item_word").agg(best.alias("b")).select(F.col("item").alias(item_col), "item_word", "b.length", F.col("b.id").alias(id_col), "b.word")
