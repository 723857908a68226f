"""Registered queries of the numbered operators: thin callers with production parameters, and their SQL.

Every query reads its whole tables. Operators that SQL cannot express (they
use Spark's own hashes, trained networks, tokenizers or files) have none here
and are held against brute force in the tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_cnn, centroid_clusters, conversation_trie, html_text, jaccard_join, pfair_mix, preference_chat, quality_rules,
               sentence_pieces, token_files, topk_search, uniform_shards, url_rules)

#: Target weights of the mix: the source with a third of all rows is held at 5 of 24 parts.
MIX_WEIGHTS, MIX_DEFAULT = {"src0": 5}, 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "failed_rules")


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode(table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_chat.preferences(table(spark, sf_dir, "conversations"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.documents(token_files.write(table(spark, sf_dir, "documents")))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op10_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair_mix.place(docs, MIX_WEIGHTS, MIX_DEFAULT).select(
        "doc_id", "source", F.col("__mix_block").alias("block"), F.col("__mix_slot").alias("slot"),
        F.col("__mix_rank").alias("rank"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster(table(spark, sf_dir, "embeddings"))


def op13_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return uniform_shards.place(table(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("__shard_no").alias("shard"), F.col("__shard_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


QUALITY_RULES_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (
    SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n > 1) GROUP BY 1),
c AS (
  SELECT d.doc_id, stratum, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(r.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals
  FROM d LEFT JOIN r USING (doc_id)),
m AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         [least(100, 100 * n_symbols // greatest(n_words, 1)), least(100, 100 * n_capitals // greatest(word_chars, 1)),
          least(100, 100 * n_repeat_words // greatest(n_words, 1)),
          least(100, 100 * (len(lines) - len(list_distinct(lines))) // greatest(len(lines), 1))] AS levels
  FROM c),
held AS (
  SELECT stratum, r AS rule, levels[r] AS level, q >= 1 AS good
  FROM m JOIN (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1) USING (doc_id),
       (SELECT unnest([1, 2, 3, 4]) AS r) WHERE NOT base_failed),
tests AS (
  SELECT stratum, rule, c, count(*) FILTER (good) AS n, count(*) FILTER (good AND level > c) AS k,
         count(*) FILTER (NOT good AND level > c) - 5 * count(*) FILTER (good AND level > c) AS gain
  FROM held, (SELECT unnest(range(0, 100)) AS c) GROUP BY ALL),
tails AS (
  SELECT *, n > 0 AND list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) -
           CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END - CASE WHEN i = n THEN 0 ELSE lgamma(n - i + 1) END
           + i * ln(0.1 / 4) + (n - i) * ln(1 - 0.1 / 4))))
         <= 0.05 / (4 * (SELECT count(DISTINCT stratum) FROM held)) AS refuted
  FROM tests),
safe AS (SELECT * FROM (
  SELECT *, bool_and(refuted) OVER (PARTITION BY stratum, rule ORDER BY c DESC) AS safe FROM tails) WHERE safe),
best AS (SELECT *, max(gain) OVER (PARTITION BY stratum, rule) AS top FROM safe),
hi AS (SELECT stratum, rule, max(c) AS hi FROM best WHERE gain = top AND top > 0 GROUP BY ALL),
cut AS (
  SELECT hi.stratum, hi.rule, (hi + coalesce((SELECT max(b.c) + 1 FROM best b WHERE b.stratum = hi.stratum AND b.rule = hi.rule
           AND b.c < hi AND b.gain <> b.top), (SELECT min(b.c) FROM best b WHERE b.stratum = hi.stratum AND b.rule = hi.rule))) // 2 AS c
  FROM hi),
wide AS (SELECT stratum, map(list(rule), list(c)) AS cuts FROM cut GROUP BY 1),
judged AS (
  SELECT m.*, array_to_string(list_transform(list_filter([1, 2, 3, 4], lambda r: levels[r] > coalesce(cuts[r], 100)),
         lambda r: ['symbols', 'capitals', 'repeats', 'dup_lines'][r]), ',') AS failed_rules
  FROM m LEFT JOIN wide USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rules = '' AS kept, failed_rules
FROM judged
"""


URL_RULES_SQL = r"""
WITH p AS (
  SELECT *, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) AS after FROM p),
g AS (
  SELECT *, regexp_extract(after, '^[^?#]*') AS path, string_split(host, '.') AS l,
         list_filter(string_split(regexp_extract(after, '^[^?#]*'), '/'), lambda x: x <> '') AS seg,
         list_filter(string_split(regexp_extract(after, '^[^?#]*[?]([^#]*)', 1), '&'), lambda x: x <> '') AS q FROM h),
t AS (
  SELECT row_number() OVER () AS r, page_id, host, path, CASE WHEN host = '' THEN [] ELSE list_distinct(list_filter(list_concat(
    ['scheme=' || lower(substr(url, 1, instr(url, '://') - 1))],
    list_transform(range(1, len(l) + 1), lambda i: 'host=' || array_to_string(l[i:], '.')),
    list_transform(seg, lambda x: 'seg=' || lower(x)),
    [CASE WHEN len(seg) > 0 THEN 'ext=' || regexp_extract(seg[-1], '[.]([A-Za-z0-9]{1,5})$', 1) END, 'deep=' || len(seg)],
    list_transform(q, lambda x: 'key=' || regexp_extract(x, '^[^=]*')),
    list_transform(q, lambda x: CASE WHEN contains(x, '=') THEN 'param=' || x END),
    [CASE WHEN instr(after, '#') > 0 THEN 'fragment=yes' END]),
    lambda x: x IS NOT NULL AND x NOT IN ('scheme=', 'host=', 'ext=', 'key='))) END AS tokens
  FROM g),
b AS (
  SELECT r, tokens, bad FROM t JOIN (SELECT doc_id AS page_id, max(quality = 0 OR toxic = 1) AS bad FROM labels GROUP BY 1) USING (page_id)),
n AS (SELECT count(*) AS n, greatest(20, ceil(0.002 * count(*))) AS least FROM b),
often AS (
  SELECT coalesce(list(token), []) AS often FROM (SELECT token FROM (SELECT unnest(tokens) AS token FROM b WHERE bad) GROUP BY token
  HAVING count(*) >= (SELECT least FROM n))),
few AS (SELECT r, page_id, list_sort(list_filter(tokens, lambda x: list_contains(often, x))) AS k FROM t, often),
one AS (SELECT *, unnest(range(1, len(k) + 1)) AS i1 FROM few),
two AS (SELECT *, unnest(range(i1, len(k) + 1)) AS i2 FROM one),
three AS (SELECT *, unnest(range(i2, len(k) + 1)) AS i3 FROM two),
sets AS (SELECT DISTINCT r, page_id, list_sort(list_distinct([k[i1], k[i2], k[i3]])) AS s FROM three),
mined AS (
  SELECT s, count(*) FILTER (bad) / count(*) AS confidence, count(*) FILTER (bad) / (SELECT n FROM n) AS support
  FROM sets JOIN b USING (r) GROUP BY s
  HAVING count(*) FILTER (bad) >= (SELECT least FROM n) AND count(*) FILTER (bad) >= 0.7 * count(*)),
match AS (SELECT r, max((confidence, support, array_to_string(s, ' '))) AS m FROM sets JOIN mined USING (s) GROUP BY r),
rules AS (SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) AS r(rh, rp, verdict)),
listed AS (
  SELECT r, max((length(rh || rp), rh || rp, verdict)) AS best FROM t JOIN rules
    ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1)
SELECT page_id, host, path, best[2] AS rule, coalesce(best[3], CASE WHEN m IS NULL THEN 'allow' ELSE 'block' END) AS verdict, m[3] AS mined
FROM t LEFT JOIN listed USING (r) LEFT JOIN match USING (r)
"""

TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

PREFERENCE_SQL = """
WITH c AS (
  SELECT conv_id, list({'role': coalesce(role, 'user'), 'text': coalesce(text, '')} ORDER BY turn, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY turns[1] ORDER BY conv_id) - 1) // 2 AS couple FROM c),
two AS (SELECT list(conv_id ORDER BY len(turns) DESC, conv_id) AS ids FROM placed GROUP BY turns[1], couple),
replies AS (
  SELECT conv_id, turns, list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant') AS a FROM c),
stale AS (
  SELECT conv_id, CASE WHEN len(a) = 0 THEN turns WHEN len(a) = 1 THEN turns[:a[1] - 1]
                  ELSE list_concat(turns[:a[-1] - 1], [turns[a[-2]]]) END AS turns FROM replies),
pair AS (
  SELECT ids[1] AS chosen_id, ids[2] AS rejected_id, x.turns AS c, coalesce(y.turns, s.turns) AS r
  FROM two JOIN c x ON x.conv_id = ids[1] LEFT JOIN c y ON y.conv_id = ids[2] JOIN stale s ON s.conv_id = ids[1]),
cut AS (
  SELECT *, coalesce(list_min(list_filter(range(1, greatest(len(c), len(r)) + 1),
            lambda i: i > len(c) OR i > len(r) OR c[i] <> r[i])) - 1, len(c))::INT AS n_common FROM pair),
said AS (
  SELECT chosen_id, rejected_id, n_common, list_transform(c, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)) AS ct,
         list_transform(r, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)) AS rt, c, r FROM cut),
spans AS (
  SELECT chosen_id, side, string_agg((pos - n + 12 + length(role) + 1) || ':' || (pos - 1), ',' ORDER BY i) FILTER (role = 'assistant') AS mask
  FROM (SELECT chosen_id, side, i, role, n, sum(n) OVER (PARTITION BY chosen_id, side ORDER BY i)::BIGINT AS pos
        FROM (SELECT chosen_id, 1 AS side, i, c[i].role AS role, length(ct[i]) AS n
              FROM (SELECT *, unnest(range(n_common + 1, len(c) + 1)) AS i FROM said)
              UNION ALL
              SELECT chosen_id, 2, i, r[i].role, length(rt[i]) FROM (SELECT *, unnest(range(n_common + 1, len(r) + 1)) AS i FROM said)))
  GROUP BY ALL)
SELECT chosen_id, rejected_id, n_common, coalesce(array_to_string(ct[:n_common], ''), '') AS prompt,
       coalesce(array_to_string(ct[n_common + 1:], ''), '') AS chosen, coalesce(a.mask, '') AS chosen_mask,
       coalesce(array_to_string(rt[n_common + 1:], ''), '') AS rejected, coalesce(b.mask, '') AS rejected_mask
FROM said LEFT JOIN (SELECT * FROM spans WHERE side = 1) a USING (chosen_id) LEFT JOIN (SELECT * FROM spans WHERE side = 2) b USING (chosen_id)
"""


TRIE_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
         lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, turns, xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h FROM own, crc),
r AS (
  SELECT h.conv_id, list_concat(coalesce(b.turns[:h], []), coalesce(h.turns[h + 1:], [])) AS turns
  FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM r),
n AS (
  SELECT CASE WHEN d = 0 THEN [] ELSE turns[:d] END AS path, d, min(conv_id) AS conv_id, count(*) AS n,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = d), '')) AS ends
  FROM p GROUP BY ALL),
w AS (
  SELECT *, CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[-1].text, '[^\x20\x09-\x0D]+')) END AS words,
         md5(d || path::VARCHAR) AS id, CASE WHEN d = 1 THEN md5('0[]') WHEN d > 1 THEN md5((d - 1) || path[:d - 1]::VARCHAR) END AS up FROM n),
k AS (SELECT up AS id, count(*) AS n FROM w WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT md5(e || CASE WHEN e = 0 THEN '[]' ELSE path[:e]::VARCHAR END) AS id, sum((n - 1) * words)::BIGINT AS saved,
         count(*) FILTER (leaf) AS leaves
  FROM (SELECT w.*, k.id IS NULL AS leaf, unnest(range(0, d + 1)) AS e FROM w LEFT JOIN k USING (id)) GROUP BY 1)
SELECT w.conv_id, w.d AS depth, u.conv_id AS parent_conv_id, w.n AS n_convs, coalesce(k.n, 0) AS n_children,
       leaves AS n_leaves, saved AS saved_tokens, w.ends AS ends_sha256
FROM w LEFT JOIN w u ON u.id = w.up LEFT JOIN k ON k.id = w.id JOIN below ON below.id = w.id
"""


def _centroid_sql(k: int = 16, rounds: int = 3) -> str:
    """Lloyd's rounds by comparing every vector with all centroids; floor division for sums of either sign."""
    nearest = """
SELECT r, vec_id, min({{'d': list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i]))), 'c': c.c}}) AS m
FROM v, c{0} c GROUP BY r, vec_id"""
    step = """
a{0} AS (""" + nearest + """),
s{0} AS (SELECT m.c AS c, i, sum(x[i])::HUGEINT AS s, count(*) AS n FROM (SELECT r, m, unnest(range(1, 65)) AS i FROM a{0}) JOIN v USING (r) GROUP BY ALL),
f{0} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM s{0} GROUP BY c),
c{1} AS (SELECT c.c, coalesce(f.x, c.x) AS x FROM c{0} c LEFT JOIN f{0} f USING (c)),"""
    return """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, x))::INT - 1 AS c, x FROM v QUALIFY c < %d),
""" % k + "".join(step.format(i, i + 1) for i in range(rounds)) + """
a AS (""" + nearest.format(rounds) + """)
SELECT vec_id, m.c AS cluster, m.d::BIGINT AS distance, sum(m.d) OVER (PARTITION BY m.c)::BIGINT AS cluster_inertia,
       sum(m.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a JOIN c{0} c ON c.c = m.c
""".format(rounds)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_sentence_pieces, op3_url_rules, op4_topk_search, op5_preference_chat, op6_html_text,
        op7_byte_cnn, op8_token_files, op9_jaccard_join, op10_pfair_mix, op11_conversation_trie,
        op12_centroid_clusters, op13_uniform_shards)}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": QUALITY_RULES_SQL, "op3_url_rules": URL_RULES_SQL, "op4_topk_search": TOPK_SQL,
            "op5_preference_chat": PREFERENCE_SQL, "op11_conversation_trie": TRIE_SQL,
            "op12_centroid_clusters": _centroid_sql()}
