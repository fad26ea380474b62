"""Ranked search, the Merkle manifest and packing against brute force, on awkward rows and on the small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelwise.llm import manifest, packing, queries, ranked, tokenize

WORD = tokenize.vocabulary_path("word_bpe_49k.json")
LONG = "alpha beta 12 gamma\ndelta. " * 4000
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, tree string, number long, rank int, piece string"
ROWS = [(k, f"s{k % 4}" if k % 9 else None, "en" if k % 5 else None, k if k % 7 else None, f"row {k}\nof {k % 3} words, été Ünder {'again ' * (k % 6)}") for k in range(70)]
ROWS += [(None, "s1", "en", 1, "no\nid"), (None, None, None, None, None), (5, "s1", "en", 3, "again"), (5, "s1", "en", 3, "again"), (71, "", "en", 0, ""), (72, "s2", "de", 9, None), (73, "alone", "fr", 1, "\n\n"), (74, "s3", "en", 5, LONG), (75, "s3", "en", 5, LONG)]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 7, "t", 8, 9, "p") for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- ranked search


def terms(text):
    low = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    return re.findall(rb"[a-z0-9\x80-\xff]+", low)


def best_documents(docs, items, k=10):
    tf = [Counter(terms(t)) for _, t in docs]
    n = [sum(c.values()) for c in tf]
    n_docs, n_terms, df = sum(x > 0 for x in n), sum(n), Counter(w for c in tf for w in c)
    out = []
    for item, text in items:
        scores = Counter()
        for w in terms(text):
            for d, c in enumerate(tf):
                if w in c:
                    m = 100 - 75 + (75 * n[d] * n_docs) // n_terms
                    scores[d] += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
        ordered = sorted((-s, docs[d][0] is None, docs[d][0] or 0) for d, s in scores.items() if s > 0)[:k]
        out += [(item, place, None if null else i, -s) for place, (s, null, i) in enumerate(ordered, 1)]
    return Counter(out)


def ranks(frame):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in frame.collect())


ITEMS = [("a", "row 3 of words"), ("b", "ÉTÉ été Ünder again AGAIN again"), ("c", None), ("d", "..."), ("e", "nowhere to be found"), (None, "alpha beta"), ("a", "row 3 of words"), ("f", "id no"), ("g", "1 2 3 4 5 6 7 8 9 10 11 12 13 14")]


@pytest.mark.parametrize("sizes", [{}, {"pass_bytes": 30, "group_items": 1}, {"group_items": 2, "seed": 0}, {"seed": 2}])
def test_ranks_equal_brute_force(spark, docs, sizes):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id string, text string, rank int")
    assert ranks(ranked.rank_documents(docs, items, **sizes)) == best_documents([(r[0], r[4]) for r in ROWS], ITEMS)


def test_ranks_of_ties_and_many_documents(spark, monkeypatch):
    """Copies by the hundred, in blocks of a few documents; fewer documents than ranks; string ids."""
    monkeypatch.setattr(ranked, "CELLS", 200)
    rng = np.random.default_rng(3)
    word = lambda n: " ".join(rng.choice([f"w{k}" for k in range(40)], n))
    rows = [(k, word(int(rng.integers(1, 30)))) for k in range(300)]
    rows += [(1000 + k, rows[7][1]) for k in range(200)]
    items = [(f"i{k}", word(6)) for k in range(20)] + [("copy", rows[7][1])]
    frame, asked = spark.createDataFrame(rows, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id string, text string")
    assert ranks(ranked.rank_documents(frame, asked)) == best_documents(rows, items)
    few = ranked.rank_documents(frame.filter("doc_id < 3").withColumn("doc_id", F.col("doc_id").cast("string")), asked)
    assert {r["doc_id"] for r in few.collect()} <= {"0", "1", "2"} and few.count() > 0


def test_both_trees_drop_whole_batches():
    """A search whose k-th scores are known scores few pairs, and finds the same."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = [(k, " ".join(vocabulary[int(x)] for x in 10 * (k % 30) + rng.integers(0, 10, 8))) for k in range(120)]
    known = ranked.Items(texts, ranked.words(ranked.strings(ranked.pa.array([t for _, t in texts])), ranked.ALNUM)[2].cast(ranked.pa.large_string()))
    known.weighted(np.full(300, 1000))
    n = 2000
    owner = np.repeat(np.arange(n), 6)
    term = 10 * np.repeat(rng.integers(0, 30, n), 6) % len(known.terms) + np.tile(np.arange(6), n)
    value = rng.integers(1, 1000, len(term))
    ids = np.array(range(n), object)
    first = ranked.Best(5, np.ones(len(texts), np.int64))
    ranked.search_block(known, first, ids, owner, term, value)
    again = ranked.Best(5, first.least)
    scored = ranked.search_block(known, again, ids, owner, term, value)
    assert scored < n * len(texts) // 4
    assert [first.item.tolist(), first.score.tolist(), first.id.tolist()] == [again.item.tolist(), again.score.tolist(), again.id.tolist()]


def test_ranks_of_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "item_id string, text string")
    some = spark.createDataFrame([("a", "row")], "item_id string, text string")
    assert ranked.rank_documents(docs, none).count() == ranked.rank_documents(empty, some).count() == 0


# --- manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def tree_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + 3])) for k in range(0, len(levels[-1]), 3)])
    return levels


def proofs(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        trees[s] = own, tree_of([leaf_of(r, r[4]) for r in own])
    top = tree_of([trees[s][1][-1][0] for s in sources])
    out = []
    for place, s in enumerate(sources):
        own, levels = trees[s]
        for k, r in enumerate(own):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            now, siblings = leaf_of(r, r[4].replace("\n", "") if even and r[4] is not None else r[4]), []
            for nodes, at in ((levels, k), (top, place)):
                for level in nodes[:-1]:
                    run, own_at = level[at - at % 3 : at - at % 3 + 3], at % 3
                    siblings += run[:own_at] + run[own_at + 1 :]
                    now, at = sha("".join([*run[:own_at], now, *run[own_at + 1 :]])), at // 3
            out.append((r[0], levels[0][k], levels[-1][0], top[-1][0], sha("".join(siblings)), now, now == top[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("part", [100_000, 7])
def test_proofs_equal_brute_force(docs, part):
    found = Counter(tuple(r) for r in manifest.prove_documents(docs, part=part).collect())
    assert found == proofs(ROWS) and {r[-1] for r in found} == {True, False}


def test_proofs_of_one_leaf_and_of_none(spark, docs, empty):
    one = [r for r in ROWS if r[0] == 73]
    assert Counter(tuple(r) for r in manifest.prove_documents(docs.filter("doc_id = 73")).collect()) == proofs(one)
    assert manifest.prove_documents(empty).count() == 0


def test_trees_of_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(manifest, "STEP", 2)
    rows = [(k, "hot" if k % 3 else f"s{k}", "en", k, f"t\n{k}") for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    assert Counter(tuple(r) for r in manifest.prove_documents(frame, part=50).collect()) == proofs(rows)


def test_a_partition_fetches_only_what_it_cannot_derive(docs):
    """No fetched node lies above a leaf of the partition, and each is a sibling of a node that does."""
    built = manifest.build(docs, part=7)
    leaves = {}
    for r in built.leaves.collect():
        leaves.setdefault((r["part"], r["tree"]), set()).add(r["pos"])
        leaves.setdefault((r["part"], manifest.TOP), set()).add(r["tree"])
    wanted = [tuple(r) for r in manifest.missing(built).collect()]
    assert len(wanted) == len(set(wanted))
    for part, tree, level, idx in wanted:
        known = {x // 3**level for x in leaves[part, tree]}
        if (tree, level) != (manifest.TOP, built.height):
            assert idx not in known and idx // 3 in {x // 3 for x in known}


# --- packing


def check_places(rows, capacity=4096):
    """Sequences are gapless from 0 and hold no more than they may; returns how many there are."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def pieces_of(rows, capacity=4096):
    out = []
    for i, text in rows:
        ids = Tokenizer.from_file(WORD).encode(text or "", add_special_tokens=False).ids + [1]
        for k, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out.append((i, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return Counter(out)


@pytest.mark.parametrize("capacity", [4096, 50])
def test_pieces_and_places(docs, capacity):
    rows = packing.pack_documents(docs, capacity=capacity).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == pieces_of([(r[0], r[4]) for r in ROWS], capacity)
    least = -(-sum(r["length"] for r in rows) // capacity)
    assert least <= check_places(rows, capacity) <= least + 2


def test_packed_sequences_hold_the_ids(docs):
    packed = packing.pack_documents(docs, keep_ids=True)
    rows = packed.collect()
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert len(whole) == check_places(rows)
    for r in rows:
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    # Pieces of one length may swap places between two runs; the multiset of ids stays.
    assert Counter(x for ids in whole.values() for x in ids) == Counter(x for r in rows for x in r["ids"])


def test_packing_of_real_documents(spark, sf):
    rows = queries.QUERIES["op13_best_fit_packing"](spark, sf).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == pieces_of(texts)
    assert check_places(rows) == -(-sum(r["length"] for r in rows) // 4096)


def test_packing_of_no_documents(empty):
    assert packing.pack_documents(empty).count() == 0


def first_fit(lengths, capacity):
    free = []
    for x in sorted(lengths, reverse=True):
        k = min((k for k in range(len(free)) if free[k] >= x), key=lambda k: free[k], default=None)
        if k is None:
            free.append(capacity - x)
        else:
            free[k] -= x
    return len(free)


@pytest.mark.parametrize("seed", range(4))
def test_configurations_hold_all_pieces_in_few_sequences(seed):
    """No more sequences than best fit of single pieces takes, in a known best case as few as possible."""
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 101, 400), rng.integers(26, 60, 400), np.repeat([50, 34, 16], 60), rng.choice([1, 2, 3], 3000)][seed]
    configured = packing.configurations(Counter(lengths.tolist()), 100)
    held = Counter()
    for configuration, n in configured:
        assert n > 0 and sum(x * c for x, c in configuration) <= 100
        for x, c in configuration:
            held[x] += n * c
    assert held == Counter(lengths.tolist())
    assert sum(n for _, n in configured) <= first_fit(lengths.tolist(), 100)
    if seed == 2:
        assert sum(n for _, n in configured) == 60


def test_prices_are_those_of_a_full_search():
    lengths, values = np.array([3, 5, 7]), np.array([2.0, 5.0, 6.5])
    choice = packing.price(lengths, values, 20)
    best = lambda room: max([0.0, *(v + best(room - x) for x, v in zip(lengths.tolist(), values.tolist(), strict=True) if x <= room)])
    for first in range(3):
        copies = packing.filled(choice, lengths.tolist(), first, 20)
        assert sum(values[i] * c for i, c in copies.items()) == pytest.approx(values[first] + best(20 - int(lengths[first])))
