"""Merkle dataset manifest: a tree over every source, a tree over the sources, and an octopus multiproof for each leaf partition.

Leaves are ranged by (source, id), so that each partition holds a few unbroken runs of leaves. Their places follow from
the counts of (partition, source): no source is ranked in one task. Trees are folded in tiles of 3**STEP nodes, so a
tree of n leaves takes log(n) / log(3**STEP) shuffles, each of a 3**STEP-th of the nodes before.

A leaf partition proves all its leaves with one multiproof. A run of leaves knows an unbroken range of nodes at every
level, so the nodes it lacks are the siblings at the two ends of that range, four at most: this minimal union of missing
coordinates is worked out from the runs alone, joined with the nodes once, and sent to the partition. There the interior
nodes that its leaves share are derived once, and every leaf's own proof is read off them.

Defined results: a null field hashes as ``-``, an empty one as ``0:``; null ids come first in their source and the null
source comes first; rows that repeat an id are ordered by their digest, and rows that repeat everything are leaves of
their own with equal digests; texts of any length are hashed where they are scanned and never shuffled; an empty table
has no rows; further columns are ignored. A row without a claim (:func:`prove`) is checked as it is.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import frozen

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node; levels that one shuffle folds; leaves of a partition.
ARITY, STEP, PART = 3, 6, 100_000
#: The tree over the sources; those of the sources are numbered from 0 in their order.
TOP = -1
_POWERS = [ARITY**j for j in range(37)]


def leaf_digest(fields: list[Column]) -> Column:
    """Hex digest of a row's canonical fields, each its UTF-8 length and text, so that no field runs into the next."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]).cast("binary"), 256)


@dataclass
class Manifest:
    """``leaves`` (part, tree, pos, total, edge, id, leaf, claim), ``runs`` (part, tree, source, before, n, total) and
    ``nodes`` (tree, level, idx, digest) with all interior nodes, all subroots (tree TOP, level 0) and the leaves at the ends
    of runs; ``trees`` is the number of sources."""

    leaves: DataFrame
    runs: DataFrame
    nodes: DataFrame
    trees: int

    @property
    def height(self) -> int:
        """The level of the root in the tree over the sources."""
        return next(j for j, p in enumerate(_POWERS) if p >= self.trees)


def _folded(nodes: DataFrame) -> DataFrame:
    """(tree, level, idx, width, digest) of the next STEP levels over ``nodes`` of one level (tree, level, idx, width, digest;
    ``width``: nodes of the tree at that level), up to the level of one node."""
    tile = ARITY**STEP
    rows = nodes.groupBy("tree", "level", F.expr(f"idx div {tile}").alias("tile")).agg(F.first("width").alias("w0"), F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("a"))
    rows = rows.withColumn("a0", F.transform("a", lambda x: x["digest"])).drop("a")
    none = F.expr("cast(array() as array<string>)")

    def above(below: str) -> Column:
        groups = F.sequence(F.lit(0), F.expr(f"(size({below}) - 1) div {ARITY}").cast("int"))
        return F.transform(groups, lambda k: F.sha2(F.array_join(F.slice(below, k * ARITY + 1, ARITY), "").cast("binary"), 256))

    def numbered(j: int) -> Column:
        first = F.col("tile") * ARITY ** (STEP - j)
        return F.transform(f"a{j}", lambda x, k: F.struct((F.col("level") + j).alias("level"), (first + k).alias("idx"), F.col(f"w{j}").alias("width"), x.alias("digest")))

    for j in range(STEP):
        more = (F.col(f"w{j}") > 1) & (F.size(f"a{j}") > 0)
        rows = rows.withColumns({f"a{j + 1}": F.when(more, above(f"a{j}")).otherwise(none), f"w{j + 1}": F.expr(f"(w{j} + {ARITY - 1}) div {ARITY}")})
    made = [numbered(j) for j in range(1, STEP + 1)]
    return rows.select("tree", F.inline(F.concat(*made)))


def _tree(nodes: DataFrame) -> list[DataFrame]:
    """All levels over the given one, each STEP levels in a written table."""
    out, now, level = [], nodes.filter("width > 1"), 0
    while now.limit(1).count():
        made = frozen(_folded(now))
        out.append(made)
        level += STEP
        now = made.filter((F.col("level") == level) & (F.col("width") > 1))
    return out


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", claim: dict[str, Column] | None = None, when: Column | None = None, part: int = PART) -> Manifest:
    """The manifest of a table. With ``claim`` (field to another value of it, taken where ``when`` holds) each leaf also carries
    the digest that the claimed row would have, to be proved against the true tree."""
    spark = docs.sparkSession
    own = leaf_digest([F.col(c) for c in fields])
    other = F.when(when, leaf_digest([claim.get(c, F.col(c)) for c in fields])) if claim else F.lit(None).cast("string")
    rows = frozen(docs.select(F.monotonically_increasing_id().alias("row"), F.col(group_col).cast("string").alias("source"), F.col(id_col).alias("id"), own.alias("leaf"), other.alias("claim")))
    order = ["source", "id", "leaf", "row"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / part))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = frozen(ranged.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("i"), "source", "id", "leaf", "claim"))
    runs = placed.groupBy("part", "source").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("at"))
    of_source, upto = Window.partitionBy("source"), Window.partitionBy("source").orderBy("part")
    runs = frozen(runs.withColumns({"before": F.sum("n").over(upto) - F.col("n"), "total": F.sum("n").over(of_source)}))
    # Sources are numbered in two levels: how many begin in the partitions before, and the place among those of the own.
    fresh = runs.filter("before = 0")
    ahead = fresh.groupBy("part").agg(F.count(F.lit(1)).alias("k"))
    ahead = ahead.select("part", (F.sum("k").over(Window.orderBy("part")) - F.col("k")).alias("ahead"))  # a row for each partition
    numbered = fresh.join(ahead, "part").select(F.col("source").alias("_source"), (F.col("ahead") + F.row_number().over(Window.partitionBy("part").orderBy("source")) - 1).cast("long").alias("tree"))
    runs = frozen(runs.join(numbered, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"))
    here = runs.select(F.col("part").alias("_part"), F.col("source").alias("_source"), "at", "n", "before", "total", "tree")
    step = F.col("i") - F.col("at")
    leaves = placed.join(here, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))
    leaves = frozen(leaves.select("part", "tree", (F.col("before") + step).alias("pos"), "total", ((step < ARITY - 1) | (F.col("n") - step < ARITY)).alias("edge"), "id", "leaf", "claim"))
    made = _tree(leaves.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("total").alias("width"), F.col("leaf").alias("digest")))
    last = runs.agg(F.max("tree")).first()[0]
    trees = 0 if last is None else last + 1
    subroots = leaves.filter("total = 1").select("tree", F.col("leaf").alias("digest"))
    for one in made:
        subroots = subroots.unionByName(one.filter("width = 1").select("tree", "digest"))
    subroots = frozen(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), F.lit(trees).cast("long").alias("width"), "digest"))
    pick = ("tree", "level", "idx", "digest")
    nodes = subroots.select(*pick).unionByName(leaves.filter("edge").select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("digest")))
    for one in [*made, *_tree(subroots)]:
        nodes = nodes.unionByName(one.select(*pick))
    return Manifest(leaves, runs, nodes, trees)


def _ends(ranges: DataFrame, levels: int) -> DataFrame:
    """(part, tree, level, idx) of the siblings that a range [before, before + n) of the leaves of a tree lacks, up to its root."""
    power = F.element_at(F.array(*[F.lit(p).cast("long") for p in _POWERS[: levels + 1]]), F.col("level") + 1)
    rows = ranges.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels)))).withColumn("p", power)
    rows = rows.withColumns({"lo": F.expr("before div p"), "hi": F.expr("(before + n - 1) div p"), "width": F.expr("(total + p - 1) div p")}).filter("width > 1")
    none = F.expr("cast(array() as array<bigint>)")
    left = F.when(F.col("lo") % ARITY > 0, F.sequence(F.col("lo") - F.col("lo") % ARITY, F.col("lo") - 1)).otherwise(none)
    last = F.least(F.col("hi") - F.col("hi") % ARITY + ARITY - 1, F.col("width") - 1)
    right = F.when(F.col("hi") < last, F.sequence(F.col("hi") + 1, last)).otherwise(none)
    return rows.select("part", "tree", "level", F.explode(F.concat(left, right)).alias("idx"))


def missing(manifest: Manifest) -> DataFrame:
    """(part, tree, level, idx): the minimal union of nodes that each leaf partition has to fetch for all its proofs; none of them
    can be derived from its own leaves. The coordinate of the root is fetched too, to compare with."""
    longest = manifest.runs.agg(F.max("total")).first()[0] or 1
    levels = next(j for j, p in enumerate(_POWERS) if p >= longest)
    own = _ends(manifest.runs.select("part", "tree", "before", "n", "total"), levels)
    spans = manifest.runs.groupBy("part").agg(F.min("tree").alias("before"), (F.max("tree") - F.min("tree") + 1).alias("n"))
    spans = spans.select("part", F.lit(TOP).cast("long").alias("tree"), "before", "n", F.lit(manifest.trees).cast("long").alias("total"))
    root = spans.select("part", "tree", F.lit(manifest.height).alias("level"), F.lit(0).cast("long").alias("idx"))
    return own.unionByName(_ends(spans, manifest.height)).unionByName(root)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _climbed(digests: list[str], first: int, width: int, fetched: dict[tuple[int, int], str]) -> tuple[list[tuple[int, list[str]]], str]:
    """Of nodes from ``first`` on: their levels (index of the first node, nodes with the fetched siblings at both ends), and the
    one node above all."""
    levels = []
    while width > 1:
        low, high, level = first - first % ARITY, first + len(digests), len(levels)
        end = min(high + -high % ARITY, width)
        whole = [fetched[level, k] for k in range(low, first)] + digests + [fetched[level, k] for k in range(high, end)]
        levels.append((low, whole))
        digests = [_hash("".join(whole[k : k + ARITY])) for k in range(0, len(whole), ARITY)]
        first, width = low // ARITY, -(-width // ARITY)
    return levels, digests[0]


def _path(levels: list[tuple[int, list[str]]], index: int, start: int = 0) -> list[tuple[str, str]]:
    """What stands before and after a node, level by level."""
    out = []
    for low, whole in levels[start:]:
        own = index - low
        group = own - own % ARITY
        out.append(("".join(whole[group:own]), "".join(whole[own + 1 : group + ARITY])))
        index //= ARITY
    return out


def prove(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf. ``folded_root`` is what its claim, or
    itself without one, folds to with the true siblings, and ``verified`` says whether that is the root."""
    trees, height = manifest.trees, manifest.height
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def expand(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        fetched: dict[int, dict[tuple[int, int], str]] = {}
        for tree, level, idx, digest in zip(*(nodes.column(c).to_pylist() for c in ("tree", "level", "idx", "digest")), strict=True):
            fetched.setdefault(tree, {})[level, idx] = digest
        leaves = leaves.sort_by([("tree", "ascending"), ("pos", "ascending")])
        tree, pos, total, leaf, claim = (leaves.column(c).to_pylist() for c in ("tree", "pos", "total", "leaf", "claim"))
        starts = [k for k in range(len(tree)) if not k or tree[k] != tree[k - 1]] + [len(tree)]
        runs = [(a, *_climbed(leaf[a:b], pos[a], total[a], fetched.get(tree[a], {})), b) for a, b in zip(starts, starts[1:], strict=False)]
        if not runs:
            return pa.table({n: pa.array([], pa.bool_() if n == "verified" else leaves.schema.field("id").type if n == "id" else pa.string()) for n in names})
        top = fetched.get(TOP, {})
        above, derived = _climbed([r[2] for r in runs], tree[0], trees, top)
        root = top[height, 0]
        if derived != root:
            raise ValueError("the multiproof does not lead to the root")
        proofs, folded, subroots = [], [], []
        for a, levels, subroot, b in runs:
            shared, last, upper, tail = _path(above, tree[a]), None, [], ""
            for k in range(a, b):
                if pos[k] // ARITY != last:  # siblings from the second level on are those of the parent
                    last = pos[k] // ARITY
                    upper = _path(levels, last, 1) + shared
                    tail = "".join(x + y for x, y in upper)
                own = _path(levels[:1], pos[k])
                proofs.append(_hash("".join(x + y for x, y in own) + tail))
                now = leaf[k] if claim[k] is None else claim[k]
                for before, after in own + upper:
                    now = _hash(before + now + after)
                folded.append(now)
                subroots.append(subroot)
        columns = [leaves.column("id").combine_chunks(), pa.array(leaf), pa.array(subroots), pa.array([root] * len(leaf)), pa.array(proofs), pa.array(folded), pa.array([x == root for x in folded])]
        return pa.Table.from_arrays(columns, names)

    wanted = missing(manifest).join(manifest.nodes, ["tree", "level", "idx"]).select("part", "tree", "level", "idx", "digest")
    leaves = manifest.leaves.select("part", "tree", "pos", "total", "id", "leaf", "claim")
    kind = leaves.schema["id"].dataType.simpleString()
    return leaves.groupBy("part").cogroup(wanted.groupBy("part")).applyInArrow(expand, f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def prove_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = PART) -> DataFrame:
    """Every document proved against the manifest of all of them; half of them (those whose id's crc32 is even) claim a text
    without newlines. Null ids claim nothing."""
    even = F.col(id_col).isNotNull() & (F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0) & F.contains(F.col(text_col), F.lit("\n"))
    manifest = build(docs, id_col=id_col, claim={text_col: F.replace(F.col(text_col), F.lit("\n"), F.lit(""))}, when=even, part=part)
    return prove(manifest).withColumnRenamed("id", id_col)
