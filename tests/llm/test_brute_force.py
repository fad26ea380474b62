"""Queries against their SQL, operators against brute-force versions, and the pipeline's stages on awkward rows."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelwise.llm import decontaminate, multiindex, quality, queries, templates, toxicity
from parcelwise.llm.common import SPACED

TABLES = "documents embeddings benchmark labels".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    oracle = con.sql(queries.ORACLE_SQL[name])
    found = queries.QUERIES[name](spark, sf)
    assert sorted(found.columns) == sorted(oracle.columns)
    assert Counter(tuple(r[c] for c in oracle.columns) for r in found.collect()) == Counter(oracle.fetchall())


@pytest.mark.parametrize("group_bytes", [1 << 20, 60])
def test_longest_match_of_each_document(spark, group_bytes):
    """Items that share windows, repeat, or are shorter than a window; ties; null ids and texts; one or several groups."""
    rng = np.random.default_rng(7)
    text = lambda n: " ".join(rng.choice(["a", "b", "c"], n))
    items = [(f"i{k}", text(int(rng.integers(3, 14)))) for k in range(12)] + [("h9", "a b"), ("z", None), (None, "c c c c b")]
    items += [("i0x", items[0][1]), ("a0", items[1][1]), items[2], items[2]]
    docs = [(k, text(int(rng.integers(0, 40)))) for k in range(40)] + [(None, items[3][1]), (40, None), (41, ""), (42, f"x {items[4][1]} y {items[4][1]}")]
    docs += [docs[5], docs[5]]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, longest int, item string").repartition(3)
    bench = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id string, text string, word int")
    found = decontaminate.find_contamination(frame, bench, window=5, group_bytes=group_bytes)
    got = Counter((r["doc_id"], r["n_words"], None if r["longest"] is None else (r["longest"]["words"], r["longest"]["word"], r["longest"]["item"])) for r in found.collect())
    want = Counter()
    for i, t in docs:
        w, best = (t or "").split(), None
        for item, u in items:
            v = (u or "").split()
            for p in range(len(w)):
                for q in range(len(v)):
                    n = 0
                    while p + n < len(w) and q + n < len(v) and w[p + n] == v[q + n]:
                        n += 1
                    if n >= min(5, len(v)) and (best is None or (-n, p, item or "") < best):
                        best = (-n, p, item or "")
        want[i, len(w), best and (-best[0], *best[1:])] += 1
    assert got == want


def test_places_of_longest_matches_keep_null_ids(spark):
    words = " ".join(f"w{k}" for k in range(12))
    frame = spark.createDataFrame([(None, f"x {words}"), (-1, f"y y {words} z"), (None, f"{words} q r")], "doc_id long, text string").repartition(1)
    bench = spark.createDataFrame([("i", words), ("j", f"{words} q")], "item_id string, text string")
    found = {(r["item_id"], r["item_word"]): (r["length"], r["doc_id"], r["word"]) for r in decontaminate.longest_matches(frame, bench).collect()}
    assert found[("i", 0)] == (12, -1, 2) and found[("j", 0)] == (13, None, 0)


def test_every_vector_row_is_its_own(spark):
    """Repeated queries and candidates, ties, and columns with the operator's own names."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    x[50:60], x[60:64] = x[0], x[20]
    ids = list(range(300))
    ids[50:55] = [0] * 5  # rows that repeat id and vector of a query
    ids[60:63] = [20] * 3
    ids[70:75] = [40] * 5  # the same id with other vectors
    frame = spark.createDataFrame([(i, v.tolist(), 7, 1, 2) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>, row long, q int, i int")
    found = multiindex.search(frame, F.col("id") % 20 == 0, recall=1.0, top=7)
    got = defaultdict(list)
    for r in found.collect():
        got[r["query_id"], r["rank"]].append((r["vec_id"], round(r["score"], 9)))
    want = defaultdict(list)
    for q in range(300):
        if ids[q] % 20 == 0:
            s = (x * x[q]).sum(axis=1)
            best = sorted((i for i in range(300) if i != q), key=lambda i: (-s[i], ids[i]))[:7]
            for k, i in enumerate(best):
                want[ids[q], k + 1].append((ids[i], round(s[i], 9)))
    assert set(got) == set(want)
    right = sum((Counter(got[k]) & Counter(want[k])).total() for k in want) / sum(len(v) for v in want.values())
    assert right > 0.97 and all(len(got[k]) == len(want[k]) for k in want)
    assert multiindex.centroids_for(0) == 16 and multiindex.centroids_for(51_200) == 32 and multiindex.centroids_for(10**12) == 256


def test_quality_leaves_a_document_out_of_its_site(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.judge_documents(docs, labels).select("doc_id", "source", "lang", "evidence", "host_share", "path_share", "quality_score").collect()
    one = lambda z: 1 / (1 + math.exp(-z))
    bounded = lambda p: min(max(p, 1e-4), 1 - 1e-4)
    logit = lambda p: math.log(p) - math.log(1 - p)
    own = [one(r["evidence"]) for r in rows]
    everywhere = (sum(own) + 0.5) / (len(own) + 1)
    hosts, paths = defaultdict(list), defaultdict(list)
    for p, r in zip(own, rows, strict=True):
        hosts[r["source"]].append(p)
        paths[r["source"], r["lang"]].append(p)

    def pseudo(groups):
        groups = [(len(v), sum(v) / len(v), e) for v, e in groups if len(v) >= 2]
        weight = sum(n * e * (1 - e) for n, _, e in groups)
        excess = (sum(n * (m - e) ** 2 for n, m, e in groups) - sum(e * (1 - e) for _, _, e in groups)) / weight
        return quality.MOST_PSEUDO if excess <= 0 else min(quality.MOST_PSEUDO, max(quality.LEAST_PSEUDO, 1 / excess - 1))

    a = pseudo([(v, everywhere) for v in hosts.values()])
    b = pseudo([(v, bounded((sum(hosts[h]) + a * everywhere) / (len(hosts[h]) + a))) for (h, _), v in paths.items()])
    for p, r in zip(own, rows, strict=True):
        h, q = hosts[r["source"]], paths[r["source"], r["lang"]]
        host = bounded((sum(h) - p + a * everywhere) / (len(h) - 1 + a))
        path = bounded((sum(q) - p + b * host) / (len(q) - 1 + b))
        assert (r["host_share"], r["path_share"], r["quality_score"]) == pytest.approx((host, path, one(logit(path) + r["evidence"] - logit(everywhere))), rel=1e-6)


def test_window_lengths_are_those_of_single_compressions():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdef"), 5)) for _ in range(200)]
    texts = [" ".join(words[int(k)] for k in rng.integers(0, 200, n)) for n in (0, 1, 50, 400)]
    packers = tuple(toxicity.compressor(" ".join(words[a:b]).encode()) for a, b in ((0, 60), (60, 120)))
    rows = toxicity.features(pa.array([*texts, None]), packers)
    for text, row in zip([*texts, ""], rows, strict=True):
        data, cuts = text.encode().translate(SPACED), [0]
        while len(data) > (k := len(cuts) * toxicity.WINDOW):
            cut = data.find(b" ", k)
            cuts.append(len(data) if cut < 0 else cut)
        cuts = sorted({c for c in cuts if c < len(data)} | {0, len(data)}) if data else [0, 0]
        gain = [len(packers[1].compress(data[a:b] or b" ")) - len(packers[0].compress(data[a:b] or b" ")) for a, b in zip(cuts, cuts[1:], strict=False)]
        assert row[0] == pytest.approx(np.mean(gain)) and row[1] == pytest.approx(np.mean([g >= 2 for g in gain])) and row[6] == max(gain)


def test_two_labels_texts_and_long_texts_in_the_toxic_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(i, None if n is None else "x" * n) for i, n in ((0, 5), (0, 9), (2, 400), (3, 30), (5, None))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in (0, 2, 3, 5)], "doc_id long, toxic int")
    train = {i for i in (0, 2, 3, 5) if zlib.crc32(str(i).encode()) % 3 != 1}
    found = toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic")
    assert {i for i, _, _ in found} == train and len(found) == len(train)
    monkeypatch.setattr(toxicity, "CLASS_BYTES", 50)
    assert {i for i, _, _ in toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic")} == train - {2}


def by_all_pairs(docs, depth=3, similar=0.7, least=3):
    """Which lines stay, by comparing every line of a leaf with every other."""
    mask = lambda line: tuple("<*>" if any(c.isdigit() for c in t) else t for t in line.split())
    holders = defaultdict(set)
    for i, t in docs:
        for line in t.split("\n"):
            if mask(line):
                holders[mask(line)].add(i)
    leaves, gone = defaultdict(list), set()
    for m in holders:
        leaves[len(m), m[:depth]].append(m)
    for leaf in leaves.values():
        for m in leaf:
            near = [o for o in leaf if o == m or sum(a == b != "<*>" for a, b in zip(o, m, strict=True)) / len(m) >= similar]
            ids = set().union(*(holders[o] for o in near))
            if len(ids) >= least:
                gone |= {(i, m) for i in holders[m] - {min(ids)}}
    return {i: "\n".join(x for x in t.split("\n") if not mask(x) or (i, mask(x)) not in gone) for i, t in docs}


def small_blocks(monkeypatch, block_lines):
    kept = templates.templates_of.__defaults__
    monkeypatch.setattr(templates.templates_of, "__defaults__", (*kept[:-1], block_lines))


@pytest.mark.parametrize("block_lines", [1024, 50, 3])
def test_drifting_lines_do_not_depend_on_blocks(spark, monkeypatch, block_lines):
    """Leaves of lines that drift away from each other step by step, many pairs of them just similar enough."""
    small_blocks(monkeypatch, block_lines)
    rng, docs = np.random.default_rng(12), []
    for leaf in range(4):
        width = (10, 10, 6, 21)[leaf]
        line = [f"{'abcd'[leaf]}x"] * width
        for _ in range(70):
            for place in rng.integers(3, width, 2):
                line[place] = "v" + "abcdefgh"[rng.integers(0, 8)]
            docs.append((int(rng.integers(0, 90)), " ".join(line if rng.random() < 0.9 else [*line[:-1], "no7"])))
    texts = defaultdict(list)
    for i, line in docs:
        texts[i].append(line)
    docs = [(i, "\n".join(x)) for i, x in texts.items()]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = by_all_pairs(docs)
    assert 10 < sum(t.count("\n") - want[i].count("\n") for i, t in docs) < 270
    assert {r["doc_id"]: r["text"] for r in templates.drop_recurring_lines(frame).collect()} == want


def test_templates_are_where_all_similar_lines_agree(spark, monkeypatch):
    small_blocks(monkeypatch, 2)
    lines = [f"a b c d e f {x} {y} i j" for x, y in ("gh", "gz", "yh", "yz", "qh")] + ["a b c 0 1 2 g h i j", "a b c k l m n o p q"]
    rows = [(1, k, " ".join("<*>" if t.isdigit() else t for t in x.split()), [k]) for k, x in enumerate(lines)]
    found = templates.templates_of(spark.createDataFrame(rows, "leaf long, masked long, line string, ids array<long>"))
    got = {r["masked"]: (r["template"], r["ids"]) for r in found.collect()}
    assert got == {k: ("a b c d e f <*> <*> i j", [0, 1, 2]) for k in range(5)} | {5: ("a b c <*> <*> <*> g h i j", [0, 5]), 6: (lines[6], [6])} | {
        0: ("a b c <*> <*> <*> <*> <*> i j", [0, 1, 2])
    }


@pytest.mark.parametrize("block_lines", [1024, 3])
def test_line_templates_equal_brute_force(spark, monkeypatch, block_lines):
    """Families of lines that differ in one place, within leaves that hold several families; blocks do not matter."""
    small_blocks(monkeypatch, block_lines)
    rng, docs = np.random.default_rng(6), []
    for i in range(60):
        lines = []
        for _ in range(6):
            f = int(rng.integers(0, 14))
            body = [f"w{chr(97 + f)}{chr(97 + k)}" for k in range(7)]
            if f % 2:
                body[3] = "v" + "".join(rng.choice(list("abcdefgh"), 6))  # the variable field
            lines.append(" ".join(["it", "is", "so", *body]) + (f" no {rng.integers(0, 99)}" if f % 3 else ""))
        docs.append((i, "\n".join([*lines, "", f"own {chr(97 + i % 26)}{chr(97 + i // 26)} line"])))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["text"] for r in templates.drop_recurring_lines(frame).collect()} == by_all_pairs(docs)


def test_stages_keep_awkward_rows_and_columns(spark, sf):
    """Nulls, empty and long texts, repeated rows, clashing columns, a table without n_chars, an empty table."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    own = {"keep": "x", "n_lines": "y", "id": "z", "component_id": "c", "set": "s", "root": "r", "key": "k", "evidence": "e", "label": "l"}
    odd = spark.createDataFrame([(None, None), (-1, None), (-2, ""), (-3, " \n "), (-4, "word " * 60_000), (None, "a text without an id")], "doc_id long, text string")
    table = docs.select("doc_id", "text", "lang", "source").unionByName(odd, allowMissingColumns=True)
    table = table.unionByName(table).withColumns({k: F.lit(v) for k, v in own.items()})
    n = docs.select("text").distinct().count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, sf)
        rows = out.collect()
        assert stage(spark, table.limit(0), sf).count() == 0, name
        if name != "BPE encoding and decoding":
            assert out.columns == table.columns and all(r[k] == v for r in rows for k, v in own.items()), name
        if name == "n-gram Jaccard join":
            ids = Counter(r["doc_id"] for r in rows)
            assert max(v for k, v in ids.items() if k is not None and k not in (-1, -2, -3)) == 1 and ids[-1] == 2 and ids[None] == 4 and 0 < len(rows) <= n + 12
    with_index = {r["doc_id"] for r in corpus_pipeline.keep_good(spark, table, sf).collect()}
    judged = quality.judge_documents(table.drop("keep", "evidence"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert with_index == {r["doc_id"] for r in judged.filter("keep").collect()}


def test_every_stage_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = {r["doc_id"]: r for r in corpus_pipeline.drop_lines(spark, docs, sf).collect()}
    want = by_all_pairs([(i, t or "") for i, t in rows])
    for i, t in rows:
        assert (i in found) == (want[i] == (t or "") or want[i].strip(" ") != "")
        if i in found and t is not None:
            assert found[i]["text"] == want[i] and (want[i] == t or found[i]["n_chars"] == len(want[i]))


@pytest.mark.parametrize("scale", [1.0, 1e8, 1e200])
def test_nearest_of_products_that_cancel_or_overflow(scale):
    """Large vectors nearly at right angles, whose products are rounding, and products beyond all doubles."""
    rng = np.random.default_rng(9)
    queries, entries = rng.normal(size=(6, 8)) * scale, rng.normal(size=(300, 8)) * scale
    unit = queries[0] / np.abs(queries[0]).max()
    entries[:200] -= (entries[:200] @ unit)[:, None] / (unit @ unit) * unit
    open_ = rng.random((6, 300)) < 0.9
    open_[1, 3:] = False  # fewer candidates than are asked for
    rows, ids = np.arange(6), np.arange(300) % 90
    found = {k: (i.tolist(), s.tolist()) for k, i, s in multiindex.best_of(queries, rows, entries, np.arange(300), ids, open_, 20)}
    for k in range(6):
        seen = [e for e in range(300) if open_[k, e] and e != k]
        with np.errstate(all="ignore"):
            scores = (entries[seen] * queries[k]).sum(axis=1)
        order = np.lexsort((ids[seen], -scores))[:20]
        assert found[k][0] == ids[seen][order].tolist() and np.array_equal(found[k][1], scores[order], equal_nan=True)
