"""The registered queries of this subpackage, and SQL for those that SQL can express.

Each query takes the whole table through its operator and derives the digest columns of
its contract from the operator's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, factor_machine, hard_negatives, jaccard_join, langid, line_dedup, mixing, permutation_index, perplexity, prefix_trie, substring_dedup, suffix_dedup, toxicity
from .common import crc_mod, read


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    langs, scorer = langid.fit(docs.filter(~held_out))
    return langid.predict(docs, langs, scorer, extra={"held_out": held_out})


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeated_passages(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.judge_documents(read(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeated_bytes(read(spark, sf_dir, "documents"), keep="none")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def label_domain():
    """Domains of the labelled table: junk, toxic, clean."""
    return F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return mixing.mix(docs, labels, label_domain())


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.drop_common_lines(docs, stats=True)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.tokenize(read(spark, sf_dir, "documents"), vocabulary()))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    labels = read(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("quality").alias("label"))
    machine = factor_machine.fit(docs.select("doc_id", "text").join(labels, "doc_id"))
    out = factor_machine.predict(docs, machine)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    labels = read(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs.select("doc_id", "text").join(labels, "doc_id"))
    out = toxicity.predict(docs, model, extra={"held_out": held_out})
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_matches", "n_misspelled", "quoted")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.paths(read(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie.build(prefix_trie.spliced(own, F.col("conv_id") - F.col("conv_id") % 5, head))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_permutation_index": op1_permutation_index,
    "op2_language_id": op2_language_id,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_mixing": op6_mixing,
    "op7_line_dedup": op7_line_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_bpe": op9_bpe,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_toxicity": op12_toxicity,
    "op13_prefix_trie": op13_prefix_trie,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

def _crc32(text: str) -> str:
    """CRC-32 of a short decimal text in SQL: bit by bit over its bits."""
    poly = 0xEDB88320
    bits = f"list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length({text}) + 1), lambda i: [256 + ascii(substr({text}, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x - 256) WHEN c & 1 = 1 THEN xor(c >> 1, {poly}) ELSE c >> 1 END)"
    return f"xor({bits}, 4294967295)"


_TRIE = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS i,
    sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k, strlen(coalesce(text, '')) AS n FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM t),
r AS (SELECT c.conv_id, i, k, n FROM c JOIN t ON t.conv_id = base AND i <= h UNION ALL SELECT c.conv_id, i, k, n FROM c JOIN t ON t.conv_id = c.conv_id AND i > h),
p AS (SELECT conv_id, list(k ORDER BY i) AS ks, list(n ORDER BY i) AS ns FROM r GROUP BY conv_id),
q AS (SELECT c.conv_id, coalesce(ks, []) AS ks, coalesce(ns, []) AS ns FROM c LEFT JOIN p USING (conv_id)),
m AS (SELECT conv_id, unnest(range(len(ks) + 1)) AS depth, ks, ns FROM q),
a AS (SELECT conv_id, depth, array_to_string(ks[1:depth], ',') AS node, CASE WHEN depth > 0 THEN array_to_string(ks[1:depth - 1], ',') END AS up, CASE WHEN depth > 0 THEN ns[depth] ELSE 0 END AS n, len(ks) = depth AS ends FROM m),
g AS (SELECT node, depth, up, n, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM a GROUP BY ALL),
k AS (SELECT up AS node, count(*) AS n_children FROM g WHERE up IS NOT NULL GROUP BY up),
v AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k USING (node)),
s AS (SELECT above.node, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.n) AS saved
  FROM v JOIN a ON a.node = v.node AND a.conv_id = v.conv_id JOIN a above ON above.conv_id = v.conv_id AND above.depth <= v.depth GROUP BY above.node)
SELECT v.conv_id, v.depth::BIGINT AS depth, w.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs, v.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM v JOIN s USING (node) LEFT JOIN v w ON v.up = w.node"""

ORACLE: dict[str, str] = {
    "op3_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 49), ' ')) AS k FROM s),
m AS (SELECT k, min(doc_id) AS least FROM h GROUP BY k),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM h JOIN m USING (k) WHERE doc_id > least),
x AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) > 0),
k AS (SELECT x.doc_id, x.w[x.i] AS word, x.i, g.i AS gone FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.i = g.i),
a AS (SELECT doc_id, count(*) AS n, count(gone) AS r, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone IS NULL) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.n, 0)::BIGINT AS n_words, coalesce(a.r, 0)::BIGINT AS n_removed, sha256(coalesce(a.kept, '')) AS kept_sha256
FROM d LEFT JOIN a USING (doc_id)""",
    "op5_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM d WHERE length(h) >= 400),
t AS (SELECT doc_id, p, md5(substring(h, 2 * p + 1, 400)) AS k FROM s),
n AS (SELECT k FROM t GROUP BY k HAVING count(*) > 1),
r AS (SELECT doc_id, p FROM t WHERE k IN (SELECT k FROM n)),
o AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 0 ELSE 1 END AS new FROM r),
q AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM o),
runs AS (SELECT doc_id, run, min(p) AS a, max(p) + 200 AS b FROM q GROUP BY doc_id, run),
e AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs),
g AS (SELECT doc_id, count(*) AS spans, sum(b - a) AS removed, max(b) AS last,
        string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
      FROM e JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN spans IS NULL THEN h ELSE kept || substring(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)""",
    "op7_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
k AS (SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS stays FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, coalesce(k.doc_id <> c.stays, false) AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
    "op11_hard_negatives": """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM e a JOIN e c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10""",
    "op13_prefix_trie": _TRIE,
}
