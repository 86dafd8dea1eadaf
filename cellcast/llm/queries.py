"""The training-data operators bound to the test tables: one query each."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from cellcast.llm import (
    bitmap,
    decontam,
    embed_dedup,
    language_id,
    line_dedup,
    lm_score,
    ngram_join,
    packing,
    prefix_trie,
    secret_scan,
    sharding,
    token_align,
    token_count,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _register(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


@_register
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return decontam.digest(found)


@_register
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def held_out(modulus: int, remainder: int):
    """Whether a document's id puts it in the held-out part (a null id never does)."""
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder
    return F.coalesce(part, F.lit(False))


@_register
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    filters = language_id.learn_filters(docs.where(~held_out(4, 2)))
    found = language_id.identify(docs, filters)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "coverage")


@_register
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"))


@_register
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(~held_out(3, 1)).where("doc_id is not null and toxic is not null")
    # One label for each id, toxic if any row of it says so; texts without a label stay where they are.
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = bitmap.key_bitmap(labels.select(F.xxhash64("doc_id").alias("key")), "key")
    texts = docs.where(~held_out(3, 1)).select("doc_id", "text", F.xxhash64("doc_id").alias("key"))
    texts = bitmap.filter_rows(texts, "key", known).drop("key")
    # Labels grow with the documents: one join form at every size, never a broadcast.
    train = texts.join(labels.hint("merge"), "doc_id")
    field = toxicity.learn_field(train.select("doc_id", "text", "toxic"))
    scored = toxicity.score_toxicity(docs, field)
    return scored.select(
        "doc_id",
        held_out(3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


@_register
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


@_register
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_score.score_documents(
        _table(spark, sf_dir, "documents"), train=(F.col("doc_id").isNotNull()) & ~held_out(7, 2)
    )
    return scored.select(
        "doc_id", held_out(7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_register
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(_table(spark, sf_dir, "documents")))


@_register
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


@_register
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, summary = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return line_dedup.digest(summary)


@_register
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=8, law="rows")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_register
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_tokens(_table(spark, sf_dir, "documents"))


@_register
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.share_heads(turns))


ORACLE_SQL["op1_decontaminate"] = f"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(text, '{_UPPER}', '{_LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w
  FROM benchmark),
pattern AS (
  SELECT DISTINCT item, len(w[i:i + 9]) AS size, array_to_string(w[i:i + 9], ' ') AS key
  FROM item, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS r(i)),
doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, '{_UPPER}', '{_LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), []) AS w
  FROM documents),
place AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS key
  FROM doc, (SELECT DISTINCT size FROM pattern),
    unnest(range(1, greatest(len(w) - size + 1, 0) + 1)) AS r(i)),
hit AS (SELECT doc_id, i, size, item FROM place JOIN pattern USING (size, key)),
words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM hit, unnest(range(i, i + size)) AS r(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items,
    string_agg(DISTINCT item, ',' ORDER BY item) AS ids
  FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _spans_sql(kind: str, pattern: str, rank: int) -> str:
    """Matches of a pattern with their places, as DuckDB SQL."""
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, m[i] AS match,
    CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS g,
      regexp_extract_all(text, '{pattern}') AS m FROM doc),
    unnest(range(1, len(m) + 1)) AS r(i)"""


_CLASS = "[A-Za-z0-9+/_=-]"
ORACLE_SQL["op8_secrets"] = f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS (
  SELECT doc_id, kind, rank, s, s + length(match) AS e FROM (
    {_spans_sql("assign", secret_scan.ASSIGN, 0)} UNION ALL
    {_spans_sql("access", secret_scan.ACCESS, 1)} UNION ALL
    {_spans_sql("hex", secret_scan.HEX, 2)})
  WHERE kind <> 'assign' OR length(regexp_replace(match,
    '(?i)^(password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?', '')) >= 6),
candidate AS (
  SELECT doc_id, s, match, is_hex, CASE WHEN is_hex THEN lower(match) ELSE match END AS run FROM (
    SELECT *, regexp_matches(match, '{secret_scan.HEX_RUN}') AS is_hex FROM (
      {_spans_sql("candidate", _CLASS + "{20,}", 3)}))
  WHERE regexp_matches(match, '[0-9]') AND regexp_matches(match, '[A-Za-z]')
    AND NOT regexp_matches(match, '{secret_scan.UUID_RUN}')),
entropy AS (
  SELECT doc_id, s, is_hex, i, log2({secret_scan.WINDOW}) - list_sum(list_transform(
    map_values(list_histogram(string_split(run[i:i + {secret_scan.WINDOW} - 1], ''))),
    lambda c: c * log2(c))) / {secret_scan.WINDOW} AS h
  FROM candidate, unnest(range(1, length(match) - {secret_scan.WINDOW} + 2)) AS r(i)
  WHERE NOT regexp_matches(match[greatest(1, i - {secret_scan.WINDOW}):i + 2 * {secret_scan.WINDOW} - 1],
    '{secret_scan.ALLOW}')),
added AS (
  SELECT doc_id, CASE WHEN is_hex THEN 'entropy_hex' ELSE 'entropy_base64' END AS kind, 3 AS rank,
    s + min(i) - 1 AS s, s + max(i) - 1 + {secret_scan.WINDOW} AS e
  FROM entropy
  WHERE h >= CASE WHEN is_hex THEN {secret_scan.HEX_CLASS[1]} ELSE {secret_scan.BASE64_CLASS[1]} END - 1e-9
  GROUP BY doc_id, s, is_hex),
span AS (
  SELECT *, true AS is_base FROM base UNION ALL
  SELECT *, false FROM added AS a WHERE NOT EXISTS (
    SELECT 1 FROM base AS b WHERE b.doc_id = a.doc_id AND b.s <= a.s AND a.e <= b.e)),
joined AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
    count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (is_base) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM span GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM doc LEFT JOIN joined USING (doc_id)
"""


# Lines are compared as word lists joined by a blank; variants are texts, not hashes.
ORACLE_SQL["op10_line_dedup"] = """
WITH line AS (
  SELECT doc_id, i - 1 AS line, regexp_extract_all(parts[i], '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
    unnest(range(1, len(parts) + 1)) AS r(i)),
occurrence AS (
  SELECT doc_id, line, w, array_to_string(w, ' ') AS t FROM line WHERE len(w) > 0),
firsts AS (SELECT t, any_value(w) AS w, min((doc_id, line)) AS pos FROM occurrence GROUP BY t),
variant AS (
  SELECT t, pos, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS key
  FROM firsts, unnest(range(1, len(w) + 1)) AS r(i) WHERE len(w) >= 8),
replaced AS (
  SELECT DISTINCT t FROM (
    SELECT t, pos, min(pos) OVER (PARTITION BY key, i) AS least FROM variant) WHERE pos > least),
pair AS (
  SELECT v.t, v.pos, o.t AS t2, o.pos AS pos2 FROM variant v JOIN firsts o ON o.t = v.key
  WHERE len(o.w) >= 8),
near AS (
  SELECT t FROM replaced UNION SELECT t FROM pair WHERE pos > pos2
  UNION SELECT t2 FROM pair WHERE pos2 > pos),
judged AS (
  SELECT doc_id, line, (doc_id, line) > firsts.pos AS exact, t IN (SELECT t FROM near) AS near
  FROM occurrence JOIN firsts USING (t)),
dropped AS (
  SELECT doc_id, count(*) FILTER (exact) AS n_exact, count(*) FILTER (near AND NOT exact) AS n_near,
    string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS dropped
  FROM judged WHERE exact OR near GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(parts[i], chr(10) ORDER BY i) AS kept FROM (
    SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
    unnest(range(1, len(parts) + 1)) AS r(i)
  WHERE (doc_id, i - 1) NOT IN (SELECT (doc_id, line) FROM judged WHERE exact OR near)
  GROUP BY doc_id)
SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS BIGINT)
    AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
  coalesce(dropped, '') AS dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN dropped USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# All pairs of vectors; links are closed transitively.
ORACLE_SQL["op2_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id,
  vec_id = coalesce(root, vec_id) AS kept
FROM v LEFT JOIN degree ON degree.a = vec_id LEFT JOIN root ON root.a = vec_id
"""

# All pairs that share a shingle; links are closed transitively.
ORACLE_SQL["op9_ngram_join"] = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'),
    '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM doc, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS r(i)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a)
SELECT doc.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, doc.doc_id) AS component_id
FROM doc LEFT JOIN size ON size.doc_id = doc.doc_id LEFT JOIN root ON root.a = doc.doc_id
"""

ORACLE_SQL["op13_prefix_trie"] = r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
lengths AS (SELECT c, count(*) AS len FROM turns GROUP BY c),
convs AS (
  SELECT l.c, l.c - l.c % 20 AS base, coalesce(b.len, 0) AS base_len,
         xor(list_reduce(
           list_concat([4294967295::BIGINT],
                       list_transform(range(1, length(l.c::VARCHAR) + 1),
                                      lambda i: ord(substr(l.c::VARCHAR, i::INT, 1))::BIGINT)),
           lambda crc, byte: list_reduce(
             [xor(crc, byte), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT],
             lambda r, step: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::BIGINT) ELSE r // 2 END)
         ), 4294967295::BIGINT) % 4 AS h
  FROM lengths l LEFT JOIN lengths b ON b.c = l.c - l.c % 20
),
rebuilt AS (
  SELECT t.c, t.pos - v.h + least(v.h, v.base_len) AS pos, t.role, t.text
  FROM turns t JOIN convs v ON v.c = t.c WHERE t.pos >= v.h
  UNION ALL
  SELECT v.c, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base AND t.pos < v.h
),
paths AS (
  SELECT c, pos + 1 AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         md5(array_to_string(list(md5(length(role)::VARCHAR || ':' || role || text)) OVER (PARTITION BY c ORDER BY pos), '')) AS key
  FROM rebuilt
  UNION ALL
  SELECT c, 0, 0, '' FROM convs
),
nodes AS (
  SELECT depth, key, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words FROM paths GROUP BY depth, key
),
placed AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.key AS parent_key
  FROM nodes n
  LEFT JOIN paths m ON m.c = n.conv_id AND m.depth = n.depth - 1
  LEFT JOIN nodes p ON p.depth = m.depth AND p.key = m.key
),
children AS (
  SELECT n.depth, n.key, count(p.key) AS n_children
  FROM nodes n LEFT JOIN placed p ON p.depth = n.depth + 1 AND p.parent_key = n.key GROUP BY n.depth, n.key
),
below AS (
  SELECT m.depth, m.key, sum((u.n_convs - 1) * u.words)::BIGINT AS saved_tokens,
         sum(CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves
  FROM nodes u JOIN children k ON k.depth = u.depth AND k.key = u.key
  JOIN paths m ON m.c = u.conv_id AND m.depth <= u.depth
  GROUP BY m.depth, m.key
),
last_turn AS (SELECT c, max(depth) AS depth, max_by(key, depth) AS key FROM paths GROUP BY c),
ends AS (
  SELECT depth, key, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256 FROM last_turn GROUP BY depth, key
)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, k.n_children, b.n_leaves, b.saved_tokens,
       coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM placed n
JOIN children k ON k.depth = n.depth AND k.key = n.key
JOIN below b ON b.depth = n.depth AND b.key = n.key
LEFT JOIN ends e ON e.depth = n.depth AND e.key = n.key
"""
