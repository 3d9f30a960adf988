"""The query of each operator over its whole table, with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm import calls, hosts, jaccard, licences, lines, merkle, mixing, packing, quality, tokens, topk, vectors, whitening
from catalith.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query."""

    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's words and word pieces; SQL has no longest match against a vocabulary file."""
    return tokens.token_counts(table(spark, folder, "documents"))


_CALLS_SQL = r"""
WITH s AS (
  SELECT conv_id, turn, role, generate_subscripts(p, 1) - 1 AS k, unnest(p) AS s
  FROM (SELECT *, list_filter(regexp_split_to_array(text, '[.!?]+[ \n]+|\n+'), lambda x: trim(x) <> '') AS p FROM conversations)
), a AS (SELECT *, len(regexp_split_to_array(trim(s), ' +')) AS words FROM s WHERE role = 'user'),
c AS (SELECT conv_id, turn, k, turn || '.' || k AS call_id, s, words, CASE WHEN words <= 6 THEN 'lookup' ELSE 'search' END AS name FROM a),
e AS (
  SELECT conv_id, turn, k, turn || '.' || (k // 2) AS dep, turn AS dep_turn FROM c WHERE k > 0
  UNION ALL SELECT conv_id, turn, k, (turn - 2) || '.0', turn - 2 FROM c WHERE k = 0 AND turn >= 2
), v AS (
  SELECT c.*, row_number() OVER (PARTITION BY conv_id ORDER BY turn, CASE WHEN k = 0 THEN 0 ELSE floor(log2(k)) + 1 END, call_id) - 1 AS position,
         list_sort(list_filter([
           CASE WHEN NOT EXISTS (SELECT 1 FROM c x JOIN e ON e.conv_id = x.conv_id AND e.dep = x.call_id WHERE e.conv_id = c.conv_id AND e.turn = c.turn AND e.k = c.k)
                 AND (k > 0 OR turn >= 2) THEN 'unknown call ' || CASE WHEN k > 0 THEN turn || '.' || (k // 2) ELSE (turn - 2) || '.0' END END,
           CASE WHEN name = 'lookup' AND length(s) > 40 THEN 'bound query' END,
           CASE WHEN name = 'search' AND words > 40 THEN 'bound words' END,
           CASE WHEN name = 'search' AND k > 5 THEN 'bound place' END
         ], lambda x: x IS NOT NULL)) AS errors
  FROM c
), r AS (SELECT conv_id, turn AS result_turn, (turn - 1) || '.' || k AS call_id, s AS content FROM s WHERE role = 'assistant')
SELECT conv_id, call_id, coalesce(v.turn, result_turn) AS turn, position,
       CASE WHEN position IS NULL THEN 'orphan' WHEN content IS NULL THEN 'open' ELSE 'linked' END AS status, (content IS NOT NULL)::BIGINT AS n_results,
       coalesce(array_to_string(errors, '; '), '') AS errors,
       '{' || CASE WHEN position IS NULL THEN '' ELSE '"arguments":{' || CASE WHEN name = 'search' THEN '"place":' || k || ',' ELSE '' END
              || '"query":' || to_json(s)::VARCHAR || ',"words":' || words || '},' END
       || '"conv_id":' || conv_id || ',"id":"' || call_id || '",'
       || CASE WHEN position IS NULL THEN '' ELSE '"name":"' || name || '","position":' || position || ',' END
       || '"result":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"status":"'
       || CASE WHEN position IS NULL THEN 'orphan' WHEN content IS NULL THEN 'open' ELSE 'linked' END || '"}' AS record
FROM v FULL JOIN r USING (conv_id, call_id)
"""


@query("op2_tool_calls", _CALLS_SQL)
def op2_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation's sentences as linked, ordered and checked calls."""
    made, told = calls.sentence_calls(table(spark, folder, "conversations"))
    out = calls.linked_calls(made, told, calls.SENTENCE_SCHEMAS)
    return out.withColumn("errors", F.array_join("errors", "; "))


_VECTORS_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_aggregate([x::DOUBLE * x FOR x IN embedding], 'sum') > 0 AND isfinite(list_aggregate([coalesce(x, 'nan'::FLOAT)::DOUBLE FOR x IN embedding], 'sum'))
), u AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
  WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), r(a, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, u.b FROM r JOIN u ON u.a = r.c)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept
FROM (SELECT a AS vec_id, min(c) AS component_id FROM r GROUP BY 1) JOIN (SELECT e.vec_id, count(u.b) AS n_links FROM embeddings e LEFT JOIN u ON u.a = e.vec_id GROUP BY 1) USING (vec_id)
"""


@query("op4_vector_dedup", _VECTORS_SQL)
def op4_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's links and component."""
    return vectors.near_vectors(table(spark, folder, "embeddings"))


_QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), l AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1
), g AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM d WHERE len(words) >= 5
), w AS (SELECT doc_id, i, words[i:i + 4] AS win FROM g),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM r WHERE n > 1) GROUP BY 1),
j AS (
  SELECT d.doc_id, source, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)
), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM j),
h AS (SELECT source, count(*) AS host_docs, sum(base_failed::BIGINT)::BIGINT AS host_failed FROM b GROUP BY 1),
p AS (SELECT avg(host_failed / host_docs) AS m, var_pop(host_failed / host_docs) AS v, count(*) AS n FROM h),
q AS (SELECT m, n, CASE WHEN v IS NULL OR v = 0 THEN 1000.0 ELSE least(1000.0, greatest(0.0, m * (1 - m) / v - 1)) END AS s FROM p),
k AS (
  SELECT source, host_docs, host_failed,
         CASE WHEN n < 2 THEN (host_failed + 1.0) / (host_docs + 2.0) ELSE (host_failed + m * s) / (host_docs + m * s + (1 - m) * s) END <= 0.5 AS host_kept
  FROM h, q
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept, host_docs, host_failed
FROM b JOIN k ON b.source IS NOT DISTINCT FROM k.source
"""


@query("op5_quality_rules", _QUALITY_SQL)
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules on every document, and its host's verdict."""
    found = quality.host_rules(table(spark, folder, "documents"))
    return found.select("doc_id", *quality.NAMES, "base_failed", "kept", "host_docs", "host_failed")


@query("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's set size and component of similar documents; SQL would have to expand the shingles of all texts against each other."""
    return jaccard.similar_documents(table(spark, folder, "documents"))


_LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line, len(ls) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)
), h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM l),
r AS (SELECT *, CASE WHEN i = 1 THEN -1 ELSE (lag(h) OVER w * 31 + h) % 4294967291 END AS r FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
b AS (SELECT *, i > 1 AND i < n - 1 AND r > lag(r) OVER w AND r > lead(r) OVER w AS bound FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
c AS (SELECT *, coalesce(sum(bound::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM b),
k AS (SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n_lines FROM c GROUP BY 1, 2),
f AS (
  SELECT *, n_lines > 1 AND regexp_matches(body, '[^\x20\x09-\x0D]') AND row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) > 1 AS gone FROM k
), o AS (
  SELECT doc_id, coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT gone), '') AS text, sum(n_lines)::BIGINT AS n_lines, count(*) AS n_chunks,
         count(*) FILTER (gone) AS removed_chunks, coalesce(sum(n_lines) FILTER (gone), 0)::BIGINT AS removed_lines FROM f GROUP BY 1
)
SELECT doc_id, o.text, coalesce(o.n_lines, 0) AS n_lines, coalesce(n_chunks, 0) AS n_chunks, coalesce(removed_chunks, 0) AS removed_chunks,
       coalesce(removed_lines, 0) AS removed_lines
FROM documents LEFT JOIN o USING (doc_id)
"""


@query("op6_line_dedup", _LINES_SQL)
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the chunks of lines that an earlier document holds."""
    found = lines.deduped_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", "n_lines", "n_chunks", "removed_chunks", "removed_lines")


_HOSTS_SQL = r"""
WITH RECURSIVE u AS (
  SELECT page_id, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u
), rules AS (
  SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) t(verdict, h, rp)
), m AS (
  SELECT p.page_id, p.host, p.path, arg_max(h || rp, length(h || rp)) AS rule, arg_max(verdict, length(h || rp)) AS ruled
  FROM p LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rp) GROUP BY ALL
), seeds AS (
  SELECT host, count(*) FILTER (ruled = 'allow') AS good, count(*) FILTER (ruled = 'block') AS bad FROM m WHERE ruled IS NOT NULL GROUP BY 1
), a AS (
  SELECT host AS src, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]*)', 1)) AS href FROM p WHERE host <> ''
), l AS (
  SELECT src, dst, count(*) AS w FROM (SELECT src, translate(regexp_extract(href, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]+)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM a)
  WHERE dst <> '' AND dst <> src GROUP BY 1, 2
), up(low, high) AS (
  SELECT DISTINCT host, substr(host, position('.' IN host) + 1) FROM p WHERE host LIKE '%.%.%'
  UNION SELECT high, substr(high, position('.' IN high) + 1) FROM up WHERE high LIKE '%.%.%'
), e AS (
  SELECT src, dst, sum(w) AS w FROM (SELECT * FROM l UNION ALL SELECT low, high, 1 FROM up UNION ALL SELECT high, low, 1 FROM up) GROUP BY 1, 2
), b AS (SELECT true AS t, src, dst, w FROM e UNION ALL SELECT false, dst, src, w FROM e),
n AS (SELECT t, src, dst, w / sum(w) OVER (PARTITION BY t, src) AS part FROM b),
s AS (
  SELECT host, true AS t, good / (SELECT sum(good) FROM seeds) AS score FROM seeds WHERE good > 0
  UNION ALL SELECT host, false, bad / (SELECT sum(bad) FROM seeds) FROM seeds WHERE bad > 0
), r(k, host, t, score) AS (
  SELECT 0, host, t, score FROM s
  UNION ALL
  SELECT k, host, t, sum(score) FROM (
    SELECT r.k + 1 AS k, n.dst AS host, r.t, 0.85 * r.score * n.part AS score FROM r JOIN n ON n.t = r.t AND n.src = r.host WHERE r.k < 20
    UNION ALL SELECT q.k + 1, s.host, s.t, 0.15 * s.score FROM s, (SELECT DISTINCT k FROM r WHERE k < 20) q
  ) GROUP BY 1, 2, 3
), f AS (SELECT host, coalesce(sum(score) FILTER (t), 0) AS trust, coalesce(sum(score) FILTER (NOT t), 0) AS distrust FROM r WHERE k = 20 GROUP BY 1)
SELECT page_id, m.host, path, rule, coalesce(ruled, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM m LEFT JOIN f ON f.host = m.host
"""


@query("op7_url_filters", _HOSTS_SQL)
def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's rule and verdict."""
    pages = table(spark, folder, "pages")
    return hosts.judged_pages(pages, hosts.default_rules(pages)).select("page_id", "host", "path", "rule", "verdict")


@query("op9_licence_scans", licences.licence_sql())
def op9_licence_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's licence sentences and licences."""
    return licences.licence_scan(table(spark, folder, "documents"))


@query("op8_sequence_packing")
def op8_sequence_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return packing.packed_documents(table(spark, folder, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS size FROM documents
), s AS (
  SELECT source, source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3 * sum(source_size) OVER () / 2 AS budget
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1)
), o AS (SELECT *, 2 * source_size AS stop, 2 * source_size / weight AS ratio, row_number() OVER (ORDER BY 2 * source_size / weight, source NULLS LAST) AS k FROM s),
v AS (
  SELECT *, (budget - coalesce(sum(stop) OVER below, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS l
  FROM o WINDOW below AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size, (CASE WHEN m IS NULL OR ratio < m THEN stop ELSE m * weight END)::DOUBLE AS target
  FROM (SELECT *, (SELECT arg_min(l, k) FROM v WHERE l <= ratio) AS m FROM v)
), p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, 'null')), doc_id, size
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d
)
SELECT doc_id, size, source_size, target,
       (least(size, greatest(0, floor(target) - start)) + least(size, greatest(0, floor(target) - source_size - start)))::BIGINT AS taken
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
"""


@query("op10_source_mixing", _MIX_SQL)
def op10_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mixed_documents(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op11_vector_whitening")
def op11_vector_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector along the first four directions of the covariance; SQL has no eigenvectors."""
    return whitening.whitened_vectors(table(spark, folder, "embeddings"))


_MERKLE_SQL = r"""
WITH RECURSIVE c AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]), lambda s, b:
    list_reduce(list_prepend(xor(s, b), range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1))))) % 3 = 0 AS hit
  FROM documents
), b AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
            || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS told FROM c
), d AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(told) || ':' || told, '-')) AS other FROM b
), o AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d
), t(level, lang, i, h, n) AS (
  SELECT 0, lang, i, leaf, n FROM o
  UNION ALL SELECT level + 1, lang, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8) FROM t WHERE n > 1 GROUP BY level, lang, i // 8
), s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u(level, i, h, n) AS (
  SELECT 0, i, subroot, n FROM s
  UNION ALL SELECT level + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8) FROM u WHERE n > 1 GROUP BY level, i // 8
), sides AS (
  SELECT o.lang, o.i, level, coalesce(string_agg(h, '' ORDER BY t.i) FILTER (t.i < o.i >> (3 * level)), '') AS l, coalesce(string_agg(h, '' ORDER BY t.i) FILTER (t.i > o.i >> (3 * level)), '') AS r
  FROM o JOIN t ON t.lang IS NOT DISTINCT FROM o.lang AND t.n > 1 AND t.i >> 3 = o.i >> (3 * level + 3) GROUP BY 1, 2, 3
), tops AS (
  SELECT s.lang, level, coalesce(string_agg(h, '' ORDER BY u.i) FILTER (u.i < s.i >> (3 * level)), '') AS l, coalesce(string_agg(h, '' ORDER BY u.i) FILTER (u.i > s.i >> (3 * level)), '') AS r
  FROM s JOIN u ON u.n > 1 AND u.i >> 3 = s.i >> (3 * level + 3) GROUP BY 1, 2
), p AS (
  SELECT lang, i, row_number() OVER (PARTITION BY lang, i ORDER BY level) AS step, l, r FROM (
    SELECT * FROM sides UNION ALL SELECT o.lang, o.i, 100 + level, l, r FROM o JOIN tops ON tops.lang IS NOT DISTINCT FROM o.lang)
), f(lang, i, step, node) AS (
  SELECT lang, i, 0, other FROM o
  UNION ALL SELECT f.lang, f.i, p.step, sha256(l || node || r) FROM f JOIN p ON p.lang IS NOT DISTINCT FROM f.lang AND p.i = f.i AND p.step = f.step + 1
), e AS (SELECT lang, i, arg_max(node, step) AS folded_root FROM f GROUP BY 1, 2),
q AS (SELECT lang, i, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM p GROUP BY 1, 2)
SELECT o.doc_id, o.leaf, s.subroot, (SELECT h FROM u WHERE n = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
       folded_root = (SELECT h FROM u WHERE n = 1) AS verified
FROM o JOIN s ON s.lang IS NOT DISTINCT FROM o.lang JOIN e ON e.lang IS NOT DISTINCT FROM o.lang AND e.i = o.i
LEFT JOIN q ON q.lang IS NOT DISTINCT FROM o.lang AND q.i = o.i
"""


@query("op12_merkle_manifest", _MERKLE_SQL)
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf and proof, and the root its copy, lower-cased for a third of ids, folds to."""
    return merkle.audited_documents(table(spark, folder, "documents"))


_TOP_SQL = r"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row, [floor(64 * x::DOUBLE) FOR x IN embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, a.row, b.vec_id, list_inner_product(a.x, b.x)::BIGINT AS score FROM v a JOIN v b ON a.row <> b.row AND len(a.x) = len(b.x) WHERE a.vec_id % 20 = 0
)
SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM s WINDOW w AS (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) QUALIFY row_number() OVER w <= 20
"""


@query("op13_exact_top", _TOP_SQL)
def op13_exact_top(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 vectors of the highest inner product with every 20th vector."""
    return topk.top_scores(table(spark, folder, "embeddings"))
