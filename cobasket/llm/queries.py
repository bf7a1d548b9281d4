"""The registered queries of this subpackage, each on its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cobasket.llm import (attention_lm, bpe_codec, conversations, decontam, exact_dedup, fill_in_middle, quality, simhash,
                          token_counts, token_files, toxicity, vector_join, warc)
from cobasket.llm.common import read
from cobasket.session import scratch_path

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score(read(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_digests(read(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_archive(read(spark, sf_dir, "pages"), path)
    return warc.read_records(spark, path)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), path)
    return token_files.summary(token_files.read_tokens(spark, path))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op11_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.near_duplicates(read(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.restore(fill_in_middle.transform(read(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damage(rows), every=rows)


OP1_SQL = r"""
WITH normal AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), digests AS (
    SELECT doc_id, sha256(body) AS text_sha256 FROM normal
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""

OP6_SQL = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM firsts
"""

OP10_SQL = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), wanted AS (
    SELECT DISTINCT item_id::VARCHAR AS item_id, least(len(w), 10) AS n,
           array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words WHERE len(w) > 0)
), windows AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, (SELECT DISTINCT n FROM wanted))
), found AS (
    SELECT doc_id, n, i, item_id FROM windows JOIN wanted USING (n, gram)
), words_hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, n, i FROM found)) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


OP11_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x : x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reached(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), components AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a
), counts AS (
    SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN counts USING (vec_id)
"""

OP12_SQL = """
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w,
           sha256('1:' || doc_id) AS h FROM documents
), drawn AS (
    SELECT doc_id, body, w, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS one,
           ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS two, ('0x' || h[17:24])::BIGINT % 100 AS h3,
           ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM units
), pieces AS (
    SELECT doc_id, body, n, array_to_string(w[1:least(one, two)], '') AS prefix,
           array_to_string(w[least(one, two) + 1:greatest(one, two)], '') AS middle,
           array_to_string(w[greatest(one, two) + 1:], '') AS suffix,
           CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 >= 90
                THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE WHEN form = 'plain' THEN body ELSE prefix || middle || suffix END) AS restored_sha256
FROM pieces
"""

OP13_SQL = r"""
WITH RECURSIVE sums AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' ||
                   coalesce(turn::VARCHAR, ' '), ''), lambda c : ascii(c)::BIGINT),
               lambda crc, byte : list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, step :
                   CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295::BIGINT), 4294967295) % 20 AS part
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE part WHEN 4 THEN 'user' ELSE role END AS role,
           CASE part WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM sums, (VALUES (1), (2)) AS times(time) WHERE part <> 0 AND (time = 1 OR part = 3)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           regexp_replace(text, '[ 	-
]+$', '') AS shown FROM damaged
), counted AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again FROM numbered
), rows_ AS (
    SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN again > 1 THEN 'duplicate'
                   WHEN shown[-1] NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
           role[1] || lead(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS pair
    FROM counted
), facts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM rows_ GROUP BY conv_id
), arcs(initial, before, after) AS (
    VALUES ('s', '', 's'), ('u', '', 'u'), ('u', 's', 'u'), ('u', 'a', 'u'), ('a', 'u', 'a')
), edits AS (
    SELECT conv_id, i, 'D' AS edit, before, before AS after, 2 AS cost, NULL AS line
    FROM rows_, (VALUES (''), ('s'), ('u'), ('a')) AS states(before)
    UNION ALL
    SELECT conv_id, i, 'K', before, after, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, role || ':' || text
    FROM rows_ JOIN arcs ON role[1] = initial WHERE fault IS NULL OR fault = 'truncated'
    UNION ALL
    SELECT conv_id, i, 'R', before, after, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END,
           CASE initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text
    FROM rows_, arcs WHERE initial <> 's' AND (fault IS NULL OR fault = 'truncated')
), paths AS (
    SELECT conv_id, 0 AS i, '' AS state, 0 AS cost, '' AS audit, NULL::VARCHAR AS body FROM facts
    UNION ALL
    SELECT conv_id, i, after, cost, audit, body FROM (
        SELECT e.conv_id, e.i, e.after, p.cost + e.cost AS cost, p.audit || e.edit AS audit,
               CASE WHEN e.line IS NULL THEN p.body WHEN p.body IS NULL THEN e.line ELSE p.body || chr(10) || e.line END AS body
        FROM paths p JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.i = p.i + 1 AND e.before = p.state)
    QUALIFY row_number() OVER (PARTITION BY conv_id, after ORDER BY cost, audit) = 1
), best AS (
    SELECT p.* FROM paths p JOIN facts f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.i WHERE state IN ('', 'a')
    QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY cost, audit) = 1
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_exact_dedup, op2_token_counts, op3_lm_scores, op4_bpe_codec, op5_quality, op6_warc,
                                    op7_token_files, op8_simhash, op9_toxicity, op10_decontamination, op11_vector_join,
                                    op12_fill_in_middle, op13_conversation_repair)}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express an operator on the whole tables; the others are tested against brute force."""
    return {"op1_exact_dedup": OP1_SQL, "op6_warc": OP6_SQL, "op10_decontamination": OP10_SQL,
            "op11_vector_join": OP11_SQL, "op12_fill_in_middle": OP12_SQL, "op13_conversation_repair": OP13_SQL}
