"""The operators as queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.decontaminate import find_hits
from tandem.llm.exact_dedup import mark_copies
from tandem.llm.hard_negatives import mine_negatives
from tandem.llm.language import identify
from tandem.llm.line_dedup import dedup_lines
from tandem.llm.mixture import sample_repetitions
from tandem.llm.near_dedup import near_duplicates
from tandem.llm.prefix_trie import conversation_trie
from tandem.llm.secrets import scan_secrets
from tandem.llm.token_counts import count_tokens
from tandem.llm.token_files import read_token_files, write_token_files
from tandem.llm.toxicity import score_documents
from tandem.llm.warc import mark_revisits, read_archives, write_archives
from tandem.session import new_staging_path

TOKEN_LIMIT = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_staging_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path, with_ids=False)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = find_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    c = F.col("contamination")
    return hits.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"),
        c["contaminated"].alias("contaminated"),
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return scan_secrets(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(table(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").cast("long").alias("n_passages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), TOKEN_LIMIT)


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = sample_repetitions(table(spark, sf_dir, "documents"))
    return drawn.select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_staging_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return mark_revisits(read_archives(spark, path))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents"))
    c = F.col("line_dedup")
    return found.select("doc_id", c["n_lines"].alias("n_lines"), c["n_dropped"].alias("n_dropped"), F.sha2(c["kept"], 256).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_negatives(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_decontaminate": op2_decontaminate,
    "op3_language": op3_language,
    "op4_secrets": op4_secrets,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_near_dedup": op6_near_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_mixture": op9_mixture,
    "op10_warc": op10_warc,
    "op11_line_dedup": op11_line_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}

_OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
),
w AS (
  SELECT DISTINCT item, n, array_to_string(words[i + 1:i + n], ' ') AS said
  FROM (SELECT item, words, least(13, len(words)) AS n, unnest(range(0, greatest(1, len(words) - 12))) AS i FROM b WHERE len(words) > 0)
),
p AS (
  SELECT r, n, i, array_to_string(words[i + 1:i + n], ' ') AS said
  FROM (SELECT r, words, n, unnest(range(0, len(words) - n + 1)) AS i FROM d JOIN (SELECT DISTINCT n FROM w) ON len(words) >= n)
),
h AS (SELECT r, p.n, i, item FROM p JOIN w USING (said)),
c AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(words), false) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""

_OP5 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER g AS keep_id,
       count(*) OVER (PARTITION BY normal) AS group_size,
       doc_id = first_value(doc_id) OVER g AS kept,
       sha256(normal) AS text_sha256
FROM d
WINDOW g AS (PARTITION BY normal ORDER BY points DESC, doc_id)
"""

_OP10 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
m AS (SELECT payload, min(page_id) AS first FROM p GROUP BY payload),
b AS (
  SELECT page_id, first, strlen(payload) AS n,
         list_transform(generate_series(0, 31), lambda i: CAST(('0x' || substr(sha1(payload) || '00', 1 + (5 * i) // 4, 2)) AS INTEGER)) AS two,
         payload
  FROM p JOIN m USING (payload)
)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(generate_series(0, 31),
         lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((two[i + 1] >> (3 - (5 * i) % 4)) & 31), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

_OP11 = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, i, lines[i] AS line,
         translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)
),
c AS (
  SELECT key, max(doc_id) AS top FROM l WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
k AS (SELECT l.*, c.key IS NULL OR doc_id = top AS stays FROM l LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE stays), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""

# CRC-32 bit by bit over the digits of an id; the polynomial is a fixed value.
_OP12 = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         {'r': coalesce(role, ''), 't': coalesce(text, '')} AS said,
         len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, count(*) AS n,
         xor(4294967295, list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT)),
           lambda crc, byte: list_reduce(range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, byte)),
           4294967295)) % 4 AS h
  FROM t GROUP BY conv_id
),
f AS (SELECT c.conv_id, c.base, c.h, least(c.h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN c AS b ON b.conv_id = c.base),
r AS (
  SELECT f.conv_id, t.pos, said, words FROM f JOIN t ON t.conv_id = f.base AND t.pos <= f.h
  UNION ALL
  SELECT f.conv_id, t.pos - h + taken, said, words FROM f JOIN t ON t.conv_id = f.conv_id AND t.pos > f.h
),
s AS (SELECT conv_id, list(said ORDER BY pos) AS turns, list(words ORDER BY pos) AS words FROM r GROUP BY conv_id),
w AS (SELECT f.conv_id, coalesce(turns, []) AS turns, coalesce(words, []) AS words FROM f LEFT JOIN s USING (conv_id)),
p AS (SELECT conv_id, d AS depth, turns[1:d] AS prefix, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, len(turns) = d AS ends
      FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM w)),
n AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY depth, prefix
),
m AS (SELECT p.conv_id, p.depth, n.conv_id AS node FROM p JOIN n ON n.depth = p.depth AND n.prefix = p.prefix),
u AS (SELECT n.*, m.node AS parent FROM n LEFT JOIN m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1),
k AS (SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM u WHERE depth > 0 GROUP BY parent, depth),
a AS (
  SELECT m.node AS conv_id, m.depth, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM n JOIN m ON m.conv_id = n.conv_id AND m.depth <= n.depth LEFT JOIN k ON k.conv_id = n.conv_id AND k.depth = n.depth
  GROUP BY m.node, m.depth
)
SELECT u.conv_id, u.depth, u.parent AS parent_conv_id, u.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM u JOIN a ON a.conv_id = u.conv_id AND a.depth = u.depth LEFT JOIN k ON k.conv_id = u.conv_id AND k.depth = u.depth
"""

_OP13 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

ORACLES: dict[str, str] = {
    "op2_decontaminate": _OP2.strip(),
    "op5_exact_dedup": _OP5.strip(),
    "op10_warc": _OP10.strip(),
    "op11_line_dedup": _OP11.strip(),
    "op12_prefix_trie": _OP12.strip(),
    "op13_hard_negatives": _OP13.strip(),
}
