"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.llm import (decontaminate, extraction, jaccard_join, language, lexical, line_dedup, pieces, quality, records, secrets,
                         substring_dedup, topk, whitening)
from ferrule.llm.common import table


def op1_quality_classifier(spark, sf_dir):
    return quality.score_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_jaccard_join(spark, sf_dir):
    return jaccard_join.link_components(spark, table(spark, sf_dir, "documents"))


def op3_language_id(spark, sf_dir):
    return language.identify(spark, table(spark, sf_dir, "documents"))


def op4_html_extraction(spark, sf_dir):
    return extraction.extract(spark, table(spark, sf_dir, "pages"))


def op5_decontamination(spark, sf_dir):
    return decontaminate.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_top_k(spark, sf_dir):
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"))


def op7_token_records(spark, sf_dir):
    import public_tokenizers

    return records.token_records(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_substring_dedup(spark, sf_dir):
    return substring_dedup.digest(substring_dedup.dedup(spark, table(spark, sf_dir, "documents")))


def op9_secret_scan(spark, sf_dir):
    return secrets.scan(spark, table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark, sf_dir):
    import public_tokenizers

    return pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_whitening(spark, sf_dir):
    out = whitening.whiten(spark, table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.expr("try_cast(deviation as long)"))


def op12_lexical_search(spark, sf_dir):
    return lexical.top_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_line_dedup(spark, sf_dir):
    return line_dedup.digest(line_dedup.dedup_lines(spark, table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_jaccard_join, op3_language_id, op4_html_extraction,
                                   op5_decontamination, op6_top_k, op7_token_records, op8_substring_dedup, op9_secret_scan,
                                   op10_sentencepiece, op11_whitening, op12_lexical_search, op13_line_dedup)}

_LOWER = "translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = "unnest(regexp_extract_all(" + _LOWER % "text" + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
_STRIP = "trim(line, concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13)))"
_WORDS = r"list_filter(regexp_split_to_array(%s, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLE = {
    "op2_jaccard_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS % "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"} AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM w),
reps AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM s WHERE len(s) > 0 GROUP BY 1),
post AS (SELECT rep, len(s) AS n, unnest(s) AS x FROM reps),
pairs AS (
  SELECT a.rep AS a, b.rep AS b FROM post a JOIN post b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
  UNION ALL SELECT s.doc_id, r.rep FROM s JOIN reps r ON list_sort(s.s) = r.s
  UNION ALL SELECT r.rep, s.doc_id FROM s JOIN reps r ON list_sort(s.s) = r.s),
reach AS (SELECT doc_id AS node, doc_id AS root FROM s UNION SELECT e.b, reach.root FROM reach JOIN edges e ON e.a = reach.node)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id
FROM s JOIN (SELECT node, min(root) AS component_id FROM reach GROUP BY node) c ON c.node = s.doc_id""",
    "op6_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v) q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) t WHERE rank <= 5""",
    "op8_substring_dedup": f"""
WITH w AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS % "coalesce(text, '')"} AS w FROM documents),
x AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM w WHERE len(w) >= 35),
g AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM x),
d AS (SELECT g FROM g GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM g JOIN d USING (g)),
lists AS (SELECT r, list(i) AS gone FROM gone GROUP BY r),
kept AS (
  SELECT doc_id, len(w) AS n, coalesce(len(gone), 0) AS removed,
    CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END AS k
  FROM w LEFT JOIN lists USING (r))
SELECT doc_id, n AS n_words, removed AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept""",
    "op12_lexical_search": f"""
WITH t AS (SELECT r, doc_id, {_TERMS} AS term FROM (SELECT row_number() OVER () AS r, * FROM documents)),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
size AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
asked AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
scored AS (
  SELECT item_id, r, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (r), total GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, doc_id, score,
    CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50""",
    "op13_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT r, coalesce(doc_id, 9223372036854775807) AS doc, unnest(l) AS line, unnest(range(len(l))) AS i FROM d),
k AS (SELECT *, {_LOWER % _STRIP} AS key FROM x),
owner AS (SELECT key, min(doc) AS least FROM k WHERE length(key) >= 10 GROUP BY key),
kept AS (SELECT k.*, coalesce(least < doc, false) AS gone FROM k LEFT JOIN owner USING (key)),
g AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
  FROM kept GROUP BY r)
SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM g JOIN d USING (r)""",
}
