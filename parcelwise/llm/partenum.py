"""N-gram Jaccard join by PartEnum signatures (Arasu, Ganti, Kaushik 2006).

A document is the set of its distinct word shingles. Set sizes fall into bands so narrow that two sets with a Jaccard
similarity of at least the threshold lie in the same or in neighbouring bands, and differ in at most k shingles. In
each band the shingle domain is dealt by hash to (k + 1) / 2 parts, one of which then holds at most one difference,
and every part to three pieces, two of which then agree: the signatures are the hashes of all pairs of pieces. So
two sets that are similar enough always share a signature, whatever they hold.

How it runs: equal sets are one class from the start. Signatures travel as sorted runs cut by their top bits, into as
many ranges as the data calls for; where a signature has several sets, a star of candidate links goes from its least set
to the others. Candidates are gathered by connected component. A signature whose pieces are nearly empty says little,
and chains of them can tie most sets together; so a component of more than SPLIT_SETS sets is split further, without
losing a pair: the number of its sets that hold a shingle is counted for every shingle, and two similar sets of a
component must share one of their rarest shingles (as many of them as two similar sets may differ in, and one more). A
set most of whose shingles no other set has thus meets nobody. What is left of a component is cut into blocks of bounded
size, and every pair of blocks is one small task that compares its sets: parity bitmaps rule pairs out without error,
the sets decide the rest, and only a spanning forest of true links leaves the task, with each set's number of links. No
link between different texts is lost and no pair is listed twice.

Defined results: a text without words has no shingles and is linked with nothing; fewer words than a shingle make one
shingle; a null id is linked with nothing and has no component; repeated rows stay; rows that repeat an id with another
text are documents of their own under that id; very long texts are taken whole; an empty table gives no rows; further
columns are ignored. Shingles are 64-bit hashes and equal sets are told by a 64-bit hash of the set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import blocks, frozen, hashes, mixed, sifted, starts, strings, words
from parcelwise.llm.components import components, spread_join
from parcelwise.llm.interpolation import packed, unpacked

SHINGLE, PERCENT = 3, 90
#: Sets in one block of a candidate component.
BLOCK_SETS = 512
#: Sets of a candidate component that is split no further.
SPLIT_SETS = 64
#: Bytes of text in one block.
BLOCK = 8 << 20
#: Bytes of signatures or shingles that one range is meant to hold.
RANGE_BYTES = 16 << 20
#: Bits of the parity bitmaps that rule pairs out.
PARITY_BITS = 1024
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts end to end, sorted within each text, and how many each has."""
    codes, counts, distinct = words(strings(texts))
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    word = np.append(hashes(distinct)[codes], np.zeros(n, np.uint64))
    at = starts(counts)
    shingles = np.where(counts > 0, np.maximum(counts - n + 1, 1), 0)
    owner = np.repeat(np.arange(len(counts)), shingles)
    position = np.arange(len(owner)) + (at[:-1] - starts(shingles)[:-1])[owner]
    value = np.zeros(len(owner), np.uint64)
    for j in range(n):
        inside = position + j < at[1:][owner]
        value = mixed(value * _A + np.where(inside, word[position + j], np.uint64(j + 1)))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(counts)).astype(np.int64)


def set_hashes(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One signed 64-bit hash of every set (an empty set: 0)."""
    total = np.zeros(len(sizes), np.uint64)
    np.add.at(total, np.repeat(np.arange(len(sizes)), sizes), mixed(values ^ _C))
    return np.where(sizes > 0, mixed(total + sizes.astype(np.uint64) * _A), np.uint64(0)).view(np.int64)


def bands(largest: int, percent: int = PERCENT) -> np.ndarray:
    """Largest size of every band, up to the one after the band of ``largest``."""
    ends, size = [], 1
    while True:
        ends.append(size * 100 // percent)
        if len(ends) > 1 and ends[-2] >= largest:
            return np.array(ends, np.int64)
        size = ends[-1] + 1


def most_differences(total_size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Shingles in which two sets of this size together may differ and still reach the threshold."""
    return total_size * (100 - percent) // (100 + percent)


def signatures(values: np.ndarray, sizes: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets and the set each belongs to: those of a set's own band and of the next."""
    ends = bands(int(sizes.max(initial=1)), percent)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    own_band = np.searchsorted(ends, sizes)
    all_signatures, all_owners = [], []
    element = mixed(values ^ _B)
    for step in (0, 1):
        band = own_band + step
        k = most_differences(2 * ends[np.minimum(band, len(ends) - 1)], percent)
        parts = np.where((sizes > 0) & (k > 0), (k + 2) // 2, 0)
        live = parts[owner] > 0
        at = starts(3 * parts)
        who = owner[live]
        piece = at[who] + (mixed(values[live] ^ _A) % (3 * parts[who]).astype(np.uint64)).astype(np.int64)
        sums = np.zeros(at[-1], np.uint64)
        np.add.at(sums, piece, element[live])
        sums = mixed(sums).reshape(-1, 3)
        part_owner = np.repeat(np.arange(len(sizes)), parts)
        part = (np.arange(len(part_owner)) - (at[:-1] // 3)[part_owner]).astype(np.uint64)
        for a in range(3):
            pair = sums[:, a] * _A + sums[:, (a + 1) % 3] * _B
            all_signatures.append(mixed(pair + mixed(part * _C + (band[part_owner] * 4 + a).astype(np.uint64))))
            all_owners.append(part_owner)
    return np.concatenate(all_signatures), np.concatenate(all_owners)


def _picked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, key), the key telling texts of one id apart."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("key"))


def measured(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, key, n_shingles, set) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            values, sizes = shingle_sets(block.column("text"), n)
            yield pa.RecordBatch.from_arrays([block.column("id"), block.column("key"), pa.array(sizes), pa.array(set_hashes(values, sizes))], ["id", "key", "n_shingles", "set"])

    return _picked(docs, id_col, text_col).mapInArrow(run, "id long, key long, n_shingles long, set long")


RUNS = "range int, found binary, owner binary, sets binary, extra binary"
RUN_SCHEMA = pa.schema([("range", pa.int32()), *[(c, pa.binary()) for c in ("found", "owner", "sets", "extra")]])


def runs(found: np.ndarray, owner: np.ndarray, sets: np.ndarray, bits: int, extra: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Values and the sets they belong to (positions in ``sets``) as sorted runs, one for each range of the top bits;
    ``extra`` is a number for each set that travels along."""
    order = np.argsort(found)
    found, owner = found[order], owner[order]
    cut = np.searchsorted(found >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    extra = np.zeros(len(sets), np.int64) if extra is None else extra
    rows = []
    for r in np.flatnonzero(np.diff(cut)).tolist():
        part = slice(cut[r], cut[r + 1])
        used, where = np.unique(owner[part], return_inverse=True)
        rows.append((r, packed(np.diff(found[part], prepend=np.uint64(0))), packed(where), sets[used].tobytes(), packed(extra[used])))
    if rows:
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.binary()] * 4), strict=True)], ["range", "found", "owner", "sets", "extra"])


def joined_runs(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of a range with their sets and extras, sorted by value and set, each pair once."""
    found, owner, extra = [], [], []
    for f, o, s, e in zip(*(group.column(c).to_pylist() for c in ("found", "owner", "sets", "extra")), strict=True):
        where = unpacked(o).astype(np.int64)
        found.append(np.cumsum(unpacked(f), dtype=np.uint64))
        owner.append(np.frombuffer(s, np.int64)[where])
        extra.append(unpacked(e).astype(np.int64)[where])
    found, owner, extra = np.concatenate(found), np.concatenate(owner), np.concatenate(extra)
    order = np.lexsort((owner, found))
    found, owner, extra = found[order], owner[order], extra[order]
    new = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1]))
    return found[new], owner[new], extra[new]


def stars(sent: DataFrame) -> DataFrame:
    """(a, b): of every value that several sets share, the links of its least set to the others."""

    def meet(group: pa.Table) -> pa.Table:
        found, owner, _ = joined_runs(group)
        new = np.append(True, found[1:] != found[:-1])
        least = owner[np.flatnonzero(new)][np.cumsum(new) - 1]
        link = owner != least
        a, b = owner[link], least[link]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
        return pa.table({"a": pa.array(a[new], pa.int64()), "b": pa.array(b[new], pa.int64())})

    return sent.groupBy("range").applyInArrow(meet, "a long, b long")


def candidate_links(docs: DataFrame, text_col: str, n: int, percent: int, bits: int) -> DataFrame:
    """(a, b): a star for every signature that several sets share."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            values, sizes = shingle_sets(block.column("text"), n)
            sets = set_hashes(values, sizes)
            _, first = np.unique(sets, return_index=True)
            keep = np.zeros(len(sets), bool)
            keep[first] = True
            values, sizes, sets = values[np.repeat(keep, sizes)], sizes[keep], sets[keep]
            yield from runs(*signatures(values, sizes, percent), sets, bits)

    return stars(docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(send, RUNS))


def shared_shingles(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, n: int, bits: int) -> DataFrame:
    """(bucket, sets, size, lengths, found, holders): of each range of shingles those that several sets hold, with how many do
    (255 at most), packed by buckets of sets: a range makes a row for each bucket, however many sets it has."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            values, sizes = shingle_sets(block.column("text"), n)
            sets, first = np.unique(set_hashes(values, sizes), return_index=True)
            at = starts(sizes)
            picked = np.concatenate([values[at[i] : at[i + 1]] for i in first.tolist()])
            yield from runs(picked, np.repeat(np.arange(len(first)), sizes[first]), sets, bits, sizes[first])

    def shared(group: pa.Table) -> pa.Table:
        found, owner, size = joined_runs(group)
        new = np.append(True, found[1:] != found[:-1])
        holders = np.diff(np.append(np.flatnonzero(new), len(found)))[np.cumsum(new) - 1]
        more = holders > 1
        found, owner, size, holders = found[more], owner[more], size[more], np.minimum(holders[more], 255).astype(np.uint8)
        bucket = (mixed(owner.view(np.uint64) ^ _C) >> np.uint64(64 - bits)).astype(np.int64)
        order = np.lexsort((found, owner, bucket))
        found, owner, size, holders, bucket = found[order], owner[order], size[order], holders[order], bucket[order]
        rows = []
        for b in np.unique(bucket).tolist():
            part = slice(*np.searchsorted(bucket, [b, b + 1]).tolist())
            sets, first, lengths = np.unique(owner[part], return_index=True, return_counts=True)
            rows.append((b, sets.tobytes(), packed(size[part][first]), packed(lengths), found[part].tobytes(), holders[part].tobytes()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("bucket", "sets", "size", "lengths", "found", "holders"), columns, (pa.int32(), *[pa.binary()] * 5), strict=True)})

    picked = sifted(_picked(docs, id_col, text_col), members, {"id": "id", "key": "key"}, "maybe").filter("maybe").select("text")
    shape = "bucket int, sets binary, size binary, lengths binary, found binary, holders binary"
    return picked.mapInArrow(send, RUNS).groupBy("range").applyInArrow(shared, shape)


def rarest_links(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, n: int, percent: int, bits: int) -> DataFrame:
    """(a, b): a star for each shingle that is among the rarest of several ``members`` (set, id, key). Other documents
    that the sieve lets through add links that none of them needs, and lose none. Rarity is the number of members that hold a shingle, above 255 of them all alike, then its hash. Sets
    that are similar enough have as many of their shingles in common as leave ``|set| - ceil(percent |set| / 100)`` out,
    so their first shared shingle, in the order of rarity, is among the first of those and one more of each."""

    def choose(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_rarest(group, percent, bits), RUN_SCHEMA)

    # A bucket holds whole sets.
    return stars(shared_shingles(docs, members, id_col, text_col, n, bits).groupBy("bucket").applyInArrow(choose, RUNS))


def _rarest(table: pa.Table, percent: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Runs of the shingles that count for each set, from all that it shares with others."""
    column = lambda c: table.column(c).to_pylist()
    whole = lambda c, t: np.frombuffer(b"".join(column(c)), t)
    numbers = lambda c: np.concatenate([unpacked(x).astype(np.int64) for x in column(c)])
    found, holders, lengths = whole("found", np.uint64), whole("holders", np.uint8), numbers("lengths")
    names, owner_of_part = np.unique(whole("sets", np.int64), return_inverse=True)
    owner = np.repeat(owner_of_part, lengths)
    size = np.zeros(len(names), np.int64)
    size[owner_of_part] = numbers("size")
    total = np.bincount(owner, minlength=len(names))
    alone = size - total  # shingles that no other set has come first and link with nothing
    take = size - -(-percent * size // 100) + 1 - alone
    order = np.lexsort((found, holders, owner))
    owner, found = owner[order], found[order]
    rank = np.arange(len(owner)) - starts(total)[:-1][owner]
    pick = rank < take[owner]
    if pick.any():
        yield from runs(mixed(found[pick] ^ _B), owner[pick], names, bits)


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """The sets of the ``wanted`` (id, key, set, ...) documents beside their columns; of rows that repeat id and text
    in one block only the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK):
            _, first = np.unique(block.column("set").to_numpy(), return_index=True)
            block = block.take(pa.array(first))
            values, sizes = shingle_sets(block.column("text"), n)
            at = starts(sizes)
            yield block.drop_columns(["text"]).append_column("values", pa.array([values[at[i] : at[i + 1]].tobytes() for i in range(len(sizes))], pa.binary()))

    texts = sifted(_picked(docs, id_col, text_col), wanted, {"id": "id", "key": "key"}, "maybe").filter("maybe").drop("maybe")
    joined = wanted.join(texts, ["id", "key"]).drop("id", "key")
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in joined.schema if f.name != "text"]
    return joined.mapInArrow(run, ", ".join([*kept, "values binary"]))


def _parity(sets: list[np.ndarray]) -> np.ndarray:
    """A bit for each of PARITY_BITS hash classes: whether a set holds an odd number of its shingles."""
    out = np.zeros((len(sets), PARITY_BITS), np.uint8)
    for i, s in enumerate(sets):
        out[i] = np.bincount((s % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(out, axis=1).view(np.uint64)


def true_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each left set, the right sets (later left sets, without ``right``) that reach the threshold with it."""
    others = left if right is None else right
    marks, other_marks = _parity(left), _parity(others)
    sizes, other_sizes = np.array([len(s) for s in left]), np.array([len(s) for s in others])
    for i, s in enumerate(left):
        begin = i + 1 if right is None else 0
        k = most_differences(sizes[i] + other_sizes[begin:], percent)
        fits = np.flatnonzero(np.abs(sizes[i] - other_sizes[begin:]) <= k) + begin
        differ = np.bitwise_count(marks[i] ^ other_marks[fits]).sum(axis=1)
        near = fits[differ <= k[fits - begin]]
        if len(near):
            same = np.array([np.isin(others[j], s, assume_unique=True).sum() for j in near.tolist()])
            yield i, near[100 * same >= percent * (sizes[i] + other_sizes[near] - same)]


def verified(members: DataFrame, percent: int) -> DataFrame:
    """From (root, set, copies, blocks, block, values): forest rows (a, b, 0) and degree rows (a, null, n)."""

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        first, second = key[1].as_py(), key[2].as_py()
        rows: dict[int, tuple] = {}
        for s, c, b, v in zip(*(group.column(x).to_pylist() for x in ("set", "copies", "block", "values")), strict=True):
            rows[s] = (b, c, np.frombuffer(v, np.uint64))
        names = sorted(rows, key=lambda s: (rows[s][0] != first, s))
        cut = sum(rows[s][0] == first for s in names)
        sets = [rows[s][2] for s in names]
        copies = np.array([rows[s][1] for s in names], np.int64)
        degree = np.zeros(len(names), np.int64)
        parent = list(range(len(names)))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        forest = []
        offset = 0 if first == second else cut
        for i, near in true_links(sets[:cut], None if first == second else sets[cut:], percent):
            degree[i] += copies[near + offset].sum()
            degree[near + offset] += copies[i]
            for j in (near + offset).tolist():
                x, y = top(i), top(j)
                if x != y:
                    parent[x] = y
                    forest.append((names[i], names[j]))
        a = [x for x, _ in forest] + [names[i] for i in np.flatnonzero(degree)]
        b = [y for _, y in forest] + [None] * int((degree > 0).sum())
        n = [0] * len(forest) + degree[degree > 0].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = members.withColumn("other", F.explode(all_blocks))
    dealt = dealt.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "set", "copies", "block", "values")
    return dealt.groupBy("root", "i", "j").applyInArrow(compare, "a long, b long, n long")


def bits_for(total_bytes: float, partitions: int) -> int:
    """Bits of the ranges, so that there are two for each of ``partitions`` at least and each holds about RANGE_BYTES."""
    return max(4, int(np.ceil(np.log2(max(2 * partitions, total_bytes / RANGE_BYTES)))))


def placed_rows(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """(id, key, n_shingles, set, root, component_id, n_links) of every row; the root, null without words or id, names
    the component by its sets."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = frozen(measured(docs, id_col, text_col, n))
    whole = sizes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("shingles")).first()
    least = F.min(F.struct("id", "key"))
    classes = sizes.filter("n_shingles > 0 and id is not null").groupBy("set").agg(least.alias("_first"), F.count(F.lit(1)).alias("copies"))
    classes = frozen(classes.select("set", "_first.id", "_first.key", "copies"))
    near = components(candidate_links(docs, text_col, n, percent, bits_for(whole["shingles"] * 8 * (100 - percent) / 30, partitions)))
    members = near.withColumnRenamed("node", "set").join(classes, "set")
    members = frozen(_with_count(members, "root", whole["n"]))
    large = members.filter(F.col("n") > SPLIT_SETS)
    # Sets are dealt to as many buckets as there are ranges, so there are no more of these than their bytes call for.
    split = components(rarest_links(docs, large, id_col, text_col, n, percent, bits_for(whole["shingles"] * 12, 8)))
    split = split.withColumnRenamed("node", "set").join(classes, "set")
    members = members.filter(F.col("n") <= SPLIT_SETS).unionByName(_with_count(split, "root", whole["n"]))
    members = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK_SETS).cast("int"))
    members = frozen(members.select("root", "set", "copies", "blocks", F.pmod(F.xxhash64(F.lit(7), "set"), "blocks").cast("int").alias("block"), "id", "key"))
    found = frozen(verified(sets_of(docs, members, id_col, text_col, n), percent))
    degrees = found.filter("b is null").groupBy(F.col("a").alias("set")).agg(F.sum("n").alias("near"))
    roots = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "set")
    placed = frozen(classes.join(roots, "set", "left").join(degrees, "set", "left").withColumn("root", F.coalesce("root", "set")))
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    placed = spread_join(placed, least, "root", whole["n"]).select("set", "root", "component_id", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).cast("long").alias("n_links"), F.col("copies").alias("n"))
    linked = (F.col("n_shingles") > 0) & F.col("id").isNotNull()
    inside = spread_join(sizes.filter(linked), placed, "set", whole["n"])
    alone = sizes.filter(~linked).withColumns({"root": F.lit(None).cast("long"), "component_id": F.col("id"), "n_links": F.lit(0).cast("long")})
    return inside.unionByName(alone)


def _with_count(rows: DataFrame, key: str, total: int) -> DataFrame:
    """Rows with the number of rows ``n`` that their key has."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return spread_join(rows, counts.withColumn("k", F.col("n")), key, total, "k")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, n_links): a document's set size, the least id that it is connected with by
    links (Jaccard similarity of at least ``percent`` / 100), and how many documents it is linked with itself."""
    return placed_rows(docs, id_col, text_col, n, percent).select(F.col("id").alias(id_col), "n_shingles", "component_id", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component: the one with the least id, and of rows that repeat id and text any one. Documents
    without words or id all stay."""
    rows = frozen(placed_rows(docs, id_col, text_col, n, percent).filter("root is not null").select("root", "id", "key"))
    first = rows.groupBy("root").agg(F.min(F.struct("id", "key")).alias("f")).select("f.id", "f.key", F.lit(True).alias("stays"))
    texts = rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")).join(first, ["id", "key"], "left")
    marks = frozen(texts.filter("stays is null or n > 1").select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.coalesce("stays", F.lit(False)).alias("_stays")))
    judged = docs.withColumns({"_i": F.col(id_col).cast("long"), "_k": F.xxhash64(F.col(text_col).cast("string"))})
    judged = sifted(judged, marks, {"_i": "_id", "_k": "_key"}, "_maybe")
    asked = judged.filter("_maybe").join(marks, (F.col("_i") == F.col("_id")) & (F.col("_k") == F.col("_key")), "left").filter("_stays is null or _stays")
    # By the same keys as the join, so the texts are shuffled once.
    asked = asked.withColumn("_rn", F.when(F.col("_stays"), F.row_number().over(Window.partitionBy("_i", "_k").orderBy("_k"))).otherwise(1)).filter("_rn = 1")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return judged.filter(~F.col("_maybe")).select(*columns).unionByName(asked.select(*columns))
