"""Registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewright.llm import (
    chat,
    embedding_dedup,
    language_id,
    line_dedup,
    mixing,
    packing,
    prefix_trie,
    quality_model,
    quality_rules,
    ranked_search,
    simhash,
    suffix_dedup,
    toxicity,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.first AS dropped FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op2_line_dedup", LINE_DEDUP_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@query("op8_simhash_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens,
         md5('17:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(tokens)::BIGINT AS t FROM d GROUP BY source),
p AS (SELECT ln(t::DOUBLE / (SELECT sum(t) FROM s)) AS l FROM s WHERE t > 0),
g AS (SELECT k, k / 10000.0::DOUBLE AS a FROM (SELECT unnest(range(10001)) AS k)),
h AS (
  SELECT k, a, sum(exp(a * l)) AS z, ln(sum(exp(a * l))) - a * sum(exp(a * l) * l) / sum(exp(a * l)) AS entropy,
         (1 - a) * (max(l) - min(l)) AS spread FROM g, p GROUP BY k, a),
c AS (
  SELECT greatest(
    coalesce((SELECT max(k) FROM h WHERE entropy >= 0.95 * ln((SELECT count(*) FROM p)) - 1e-9), 0),
    (SELECT min(k) FROM h WHERE spread <= ln(4.0) + 1e-9)) AS k),
m AS (SELECT a, (SELECT sum(t) FROM s) * z * exp((1 - a) * (SELECT max(l) FROM p)) AS budget FROM h, c WHERE h.k = c.k),
w AS (SELECT source, t, pow(t, a) / (SELECT sum(pow(t, m.a)) FROM s, m WHERE t > 0) AS weight, budget FROM s, m),
b AS (SELECT source, t, weight, CASE WHEN t > 0 THEN round(weight * budget)::BIGINT ELSE 0 END AS bt FROM w),
r AS (
  SELECT d.*, b.weight, CASE WHEN t > 0 THEN bt // t ELSE 1 END AS blocks, CASE WHEN t > 0 THEN bt % t ELSE 0 END AS rest,
         sum(tokens) OVER (PARTITION BY d.source ORDER BY key) AS running
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
n AS (SELECT *, blocks + CASE WHEN rest > 0 AND running <= rest THEN 1 ELSE 0 END AS times FROM r)
SELECT doc_id, source, tokens, epoch::INTEGER AS epoch,
       md5('17:' || epoch::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')) AS block_key, round(weight, 6) AS weight
FROM (SELECT *, unnest(range(1, times::BIGINT + 1)) AS epoch FROM n WHERE times > 0)
"""


@query("op10_temperature_mix", MIX_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op5_quality_trees")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


@query("op3_chat_format")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = chat.with_trial(table(spark, sf_dir, "conversations"))
    return chat.digests(talks).drop("rewritten")


EMBEDDING_SQL = r"""
WITH RECURSIVE e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      AND list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT r.a AS vec_id, coalesce((SELECT count(*) FROM l WHERE l.a = r.a), 0) AS n_links, min(r.b) AS component_id,
       r.a = min(r.b) AS kept
FROM r GROUP BY r.a
"""


@query("op1_embedding_dedup", EMBEDDING_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(table(spark, sf_dir, "embeddings"))


TRIE_SQL = r"""
WITH o AS (
  SELECT conv_id, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id AS c, list(said ORDER BY pos) AS turns FROM o GROUP BY conv_id),
x AS (
  SELECT c, turns, c - c % 100 AS family, xor(4294967295::BIGINT, list_reduce(
    flatten(list_transform(string_split(c::VARCHAR, ''), lambda d: [unicode(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN (a & 1) = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END,
    4294967295::BIGINT)) % 6 AS h FROM s),
g AS (
  SELECT x.c, list_concat(CASE WHEN x.h > 0 THEN coalesce(list_slice(f.turns, 1, x.h), []) ELSE [] END,
                          list_slice(x.turns, x.h + 1, len(x.turns))) AS turns
  FROM x LEFT JOIN s f ON f.c = x.family),
p AS (SELECT c, len(turns) AS whole, d, CASE WHEN d > 0 THEN list_slice(turns, 1, d) ELSE [] END AS prefix
      FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM g)),
n AS (
  SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE whole = d), '')) AS ends_sha256,
         CASE WHEN d > 0 THEN (count(*) - 1) * length(prefix[d].t) ELSE 0 END AS own
  FROM p GROUP BY prefix, d),
u AS (SELECT *, CASE WHEN d > 1 THEN list_slice(prefix, 1, d - 1) ELSE [] END AS above FROM n),
k AS (SELECT u.*, (SELECT count(*) FROM u v WHERE v.d = u.d + 1 AND v.above = u.prefix) AS n_children FROM u),
b AS (SELECT k.d, k.prefix, sum(w.own)::BIGINT AS saved_tokens, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves
      FROM k JOIN k w ON w.d >= k.d AND (CASE WHEN k.d > 0 THEN list_slice(w.prefix, 1, k.d) ELSE [] END) = k.prefix
      GROUP BY k.d, k.prefix)
SELECT k.conv_id, k.d::BIGINT AS depth, f.conv_id AS parent_conv_id, k.n_convs, k.n_children, b.n_leaves, b.saved_tokens, k.ends_sha256
FROM k JOIN b ON b.d = k.d AND b.prefix = k.prefix LEFT JOIN k f ON f.d = k.d - 1 AND f.prefix = k.above AND k.d > 0
"""


@query("op11_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


SEARCH_SQL = r"""
WITH t AS (
  SELECT row, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, * FROM documents)),
d AS (SELECT row, doc_id, count(*) AS n FROM t GROUP BY row, doc_id),
c AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
f AS (SELECT row, term, count(*) AS tf FROM t GROUP BY row, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM f, c GROUP BY term, n_docs),
q AS (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT item, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, * FROM benchmark)) GROUP BY item, item_id, term),
s AS (
  SELECT item, item_id, row, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN d USING (row), c GROUP BY item, item_id, row, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""


@query("op13_ranked_search", SEARCH_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SUFFIX_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s FROM (SELECT *, unnest(range(n - 99)) AS p FROM d)),
m AS (SELECT s, min({'d': doc_id, 'p': p}) AS earliest FROM w GROUP BY s HAVING count(*) > 1),
f AS (SELECT w.doc_id, w.p, lag(w.p) OVER (PARTITION BY w.doc_id ORDER BY w.p) AS before
      FROM w JOIN m USING (s) WHERE earliest <> {'d': doc_id, 'p': p}),
i AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 100 THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY p) AS run FROM f),
g AS (SELECT doc_id, min(p) AS s, max(p) + 100 AS e FROM i GROUP BY doc_id, run),
a AS (SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS b, s AS e FROM g
      UNION ALL SELECT d.doc_id, coalesce(max(g.e), 0), any_value(d.n) FROM d LEFT JOIN g ON g.doc_id = d.doc_id GROUP BY d.doc_id),
k AS (SELECT a.doc_id, string_agg(substr(h, 2 * b + 1, 2 * (e - b)), '' ORDER BY b, e) AS kept, sum(e - b) AS n_kept
      FROM a JOIN d USING (doc_id) GROUP BY a.doc_id)
SELECT d.doc_id, d.n AS n_bytes, (d.n - k.n_kept)::BIGINT AS n_removed,
       (SELECT count(*) FROM g WHERE g.doc_id = d.doc_id) AS n_spans, sha256(unhex(k.kept)) AS kept_sha256
FROM d JOIN k USING (doc_id)
"""


@query("op12_suffix_dedup", SUFFIX_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
