"""One query for each operator of this subpackage, over the whole of the table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.llm import bpe, decontaminate, interpolation, lengths, manifest, multiindex, packing, partenum, quality, ranked, templates, tokenfile, toxicity
from parcelwise.sources.store import scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from its text, its source and its language there."""
    judged = quality.judge_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "source", "lang", "evidence", "host_share", "path_share", "quality_score", "keep")


def op2_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents under the interpolated model and under a unigram model."""
    return interpolation.score_documents(_table(spark, sf_dir, "documents"))


def op3_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact histogram of encoded lengths with its suffix sums."""
    return lengths.length_histogram(lengths.token_lengths(_table(spark, sf_dir, "documents")))


def op4_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document: how many of its words they cover, of which items they are, and the longest
    verbatim match with an item: its words, the word where it starts, and the item."""
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda done, x: done + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce("longest.words", F.lit(0)).alias("longest_words"),
        F.col("longest.word").alias("longest_at"),
        F.col("longest.item").alias("longest_item"),
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    path = scratch(spark)
    tokenfile.write_token_files(_table(spark, sf_dir, "documents"), path)
    return tokenfile.read_token_files(spark, path)


def op6_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded with shared chunks, then decoded."""
    return bpe.encode_and_decode(_table(spark, sf_dir, "documents"), digests=True)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by compression distance."""
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    return multiindex.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op9_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingle sets have a Jaccard similarity of 0.9 or more."""
    return partenum.jaccard_join(_table(spark, sf_dir, "documents"))


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines whose template recurs; the text that stays as a digest."""
    kept = templates.drop_recurring_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document proved against the manifest, half of them with texts that lost their newlines."""
    return manifest.prove_documents(_table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_deleted_interpolation": op2_deleted_interpolation,
    "op3_length_histogram": op3_length_histogram,
    "op4_suffix_decontamination": op4_suffix_decontamination,
    "op5_token_files": op5_token_files,
    "op6_bpe_chunks": op6_bpe_chunks,
    "op7_toxicity": op7_toxicity,
    "op8_inverted_multi_index": op8_inverted_multi_index,
    "op9_partenum_join": op9_partenum_join,
    "op10_line_templates": op10_line_templates,
    "op11_ranked_search": op11_ranked_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_best_fit_packing": op13_best_fit_packing,
}

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _field(x: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({x} AS VARCHAR))) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_TERMS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
#: The id's digits one by one, each with eight steps of the bitwise CRC.
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), [CAST(ord(x) AS UBIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]), lambda c, b:
  list_reduce(list_prepend(xor(c, b), CAST(range(8) AS UBIGINT[])), lambda y, i: xor(y >> 1, CASE WHEN y % 2 = 1 THEN CAST(3988292384 AS UBIGINT) ELSE CAST(0 AS UBIGINT) END))), CAST(4294967295 AS UBIGINT))"""

#: Where SQL has no counterpart (fitted models, BPE, files, approximate search) the tests hold the query
#: against brute force.
ORACLE_SQL: dict[str, str] = {
    "op4_suffix_decontamination": rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS b, coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT b, item, p AS q, least(10, len(w)) AS k, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS gram FROM (SELECT b, item, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS p FROM i WHERE len(w) > 0)),
item_of AS (SELECT DISTINCT item, k, gram FROM win),
places AS (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
x AS (SELECT r, p, k, array_to_string(w[p : p + k - 1], ' ') AS gram FROM places), found AS (SELECT r, p, x.k, item FROM x JOIN item_of USING (k, gram)),
step AS (SELECT r, b, item, x.k, p, p - q AS diagonal, p - row_number() OVER (PARTITION BY r, b, p - q ORDER BY p) AS run FROM x JOIN win USING (k, gram)),
match AS (SELECT r, item, count(*) + k - 1 AS n, min(p) - 1 AS start FROM step GROUP BY r, b, item, k, diagonal, run),
longest AS (SELECT r, item, n, start FROM match QUALIFY row_number() OVER (PARTITION BY r ORDER BY n DESC, start, item) = 1),
hit AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT DISTINCT r, unnest(generate_series(p, p + k - 1)) AS q FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated,
coalesce(longest.n, 0) AS longest_words, longest.start AS longest_at, longest.item AS longest_item
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r) LEFT JOIN longest USING (r)""",
    "op9_partenum_join": rf"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[p : p + 2], ' ') AS x FROM (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
same AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b USING (x) WHERE a.r <> b.r GROUP BY ALL),
link AS (SELECT a, b FROM same JOIN n x ON a = x.r JOIN n y ON b = y.r JOIN d p ON a = p.r JOIN d q ON b = q.r WHERE 100 * k >= 90 * (x.n + y.n - k) AND p.doc_id IS NOT NULL AND q.doc_id IS NOT NULL),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least_id AS (SELECT a, min(doc_id) AS id FROM reach JOIN d ON b = r GROUP BY a), degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, least_id.id) AS component_id, coalesce(degree.n, 0) AS n_links FROM d LEFT JOIN n USING (r) LEFT JOIN least_id ON least_id.a = r LEFT JOIN degree ON degree.a = r""",
    "op10_line_templates": r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
l AS (SELECT r, doc_id, p, s[p] AS line, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END FOR t IN regexp_extract_all(s[p], '[^\x20\x09-\x0D]+')] AS w
 FROM (SELECT r, doc_id, s, unnest(generate_series(1, len(s))) AS p FROM (SELECT r, doc_id, string_split(text, chr(10)) AS s FROM d))),
h AS (SELECT DISTINCT w, doc_id FROM l WHERE len(w) > 0 AND doc_id IS NOT NULL), k AS (SELECT w, row_number() OVER () AS n, len(w) AS size, w[1:3] AS leaf FROM (SELECT DISTINCT w FROM h)),
near AS (SELECT a.w AS w, b.w AS o FROM k a JOIN k b USING (size, leaf) WHERE a.n = b.n OR len(list_filter(list_zip(a.w, b.w), lambda z: z[1] = z[2] AND z[1] <> '<*>')) / size >= 0.7),
often AS (SELECT near.w AS w, min(doc_id) AS keeper FROM near JOIN h ON near.o = h.w GROUP BY near.w HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT l.*, coalesce(l.doc_id <> keeper, false) AS gone FROM l LEFT JOIN often ON l.w = often.w),
kept AS (SELECT r, count(*) AS n, count(*) FILTER (gone) AS dropped, string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone) AS rest FROM judged GROUP BY r)
SELECT doc_id, coalesce(n, 1) AS n_lines, coalesce(dropped, 0) AS n_dropped, CASE WHEN text IS NOT NULL THEN sha256(coalesce(rest, '')) END AS text_sha256 FROM d LEFT JOIN kept USING (r)""",
    "op11_ranked_search": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents), i AS (SELECT row_number() OVER () AS b, item_id, {_TERMS} AS w FROM benchmark),
s AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d), t AS (SELECT r, x, count(*) AS tf FROM (SELECT r, unnest(w) AS x FROM d) GROUP BY ALL),
k AS (SELECT x, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM t, s GROUP BY x, docs), q AS (SELECT b, x, count(*) AS n FROM (SELECT b, unnest(w) AS x FROM i) GROUP BY ALL),
m AS (SELECT r, 25 + (75 * len(w) * docs) // terms AS m FROM d, s WHERE len(w) > 0),
score AS (SELECT b, r, CAST(sum(n * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN k USING (x) JOIN t USING (x) JOIN m USING (r) GROUP BY b, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT b, r, score, doc_id, row_number() OVER (PARTITION BY b ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score JOIN d USING (r) WHERE score > 0) JOIN i USING (b) WHERE rank <= 10""",
    "op12_merkle_manifest": f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source, {_leaf('text')} AS leaf, CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS claim FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM d),
node(tree, level, idx, digest) AS (SELECT tree, 0, pos, leaf FROM p UNION ALL SELECT tree, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS w FROM node) WHERE w > 1 GROUP BY tree, level, idx // 3),
sub AS (SELECT tree, max(level) AS height, arg_max(digest, level) AS digest FROM node GROUP BY tree),
top(level, idx, digest) AS (SELECT 0, tree, digest FROM sub UNION ALL SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER () AS w FROM top) WHERE w > 1 GROUP BY level, idx // 3),
run AS (SELECT tree, level, idx // 3 AS g, list(digest ORDER BY idx) AS ds FROM node GROUP BY ALL UNION ALL SELECT -1, level, idx // 3, list(digest ORDER BY idx) FROM top GROUP BY ALL),
own AS (SELECT r, run.level AS k, pos // CAST(pow(3, run.level) AS BIGINT) % 3 AS o, ds FROM p JOIN sub USING (tree) JOIN run ON run.tree = p.tree AND run.level < height AND run.g = pos // CAST(pow(3, run.level + 1) AS BIGINT)
 UNION ALL SELECT r, height + run.level, p.tree // CAST(pow(3, run.level) AS BIGINT) % 3, ds FROM p JOIN sub USING (tree) JOIN run ON run.tree = -1 AND run.level < (SELECT max(level) FROM top) AND run.g = p.tree // CAST(pow(3, run.level + 1) AS BIGINT)),
path AS (SELECT r, k, array_to_string(ds[1:o], '') AS b, array_to_string(ds[o + 2:], '') AS a FROM own),
proof AS (SELECT r, string_agg(b || a, '' ORDER BY k) AS s FROM path GROUP BY r),
fold(r, k, h) AS (SELECT r, 0, coalesce(claim, leaf) FROM d UNION ALL SELECT fold.r, fold.k + 1, sha256(b || h || a) FROM fold JOIN path ON path.r = fold.r AND path.k = fold.k),
done AS (SELECT r, arg_max(h, k) AS h FROM fold GROUP BY r), root AS (SELECT arg_max(digest, level) AS root FROM top)
SELECT doc_id, leaf, sub.digest AS subroot, root, sha256(coalesce(s, '')) AS proof_sha256, h AS folded_root, h = root AS verified FROM p JOIN sub USING (tree) JOIN done USING (r) LEFT JOIN proof USING (r), root""",
}
