"""The dealt operators as queries over the given tables, with production parameters, and their SQL where SQL can say it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope.llm.chat import format_conversations, read_back
from billscope.llm.decontamination import find_contamination
from billscope.llm.embedding_dedup import near_duplicate_vectors
from billscope.llm.licenses import scan_licenses
from billscope.llm.line_dedup import dedup_lines
from billscope.llm.minhash import near_duplicates
from billscope.llm.mixing import mix_sources
from billscope.llm.prefix_trie import prefix_trie
from billscope.llm.quality import judge_quality
from billscope.llm.scratch import new_folder
from billscope.llm.token_counts import count_after_edits
from billscope.llm.token_files import read_token_files, write_token_files
from billscope.llm.toxicity import fit_toxicity, held_out, score_toxicity
from billscope.llm.whitening import whitened_embeddings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


LINE_DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line, translate(trim(parts[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT doc_id, i, line, coalesce(r.keeper <> doc_id, false) AS gone FROM lines LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each overlap of a document with a benchmark item; documents without one have no row."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


MIXING_SQL = """
WITH sizes AS (
  SELECT coalesce(source, '') AS s, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS chars FROM documents GROUP BY 1
), rates AS (
  SELECT s, (SELECT sum(chars) FROM sizes) * (pow(chars, 0.5) / (SELECT sum(pow(chars, 0.5)) FROM sizes)) / chars AS rate
  FROM sizes WHERE chars > 0
), terms AS (
  SELECT s, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p, rate
  FROM (SELECT s, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 60) AS BIGINT))) AS k FROM rates)
), cdf AS (
  SELECT s, k, sum(p) OVER (PARTITION BY s ORDER BY k) AS c FROM terms WHERE k <= rate + 1 OR p >= 1e-18
), draws AS (
  SELECT *, CAST('0x' || substr(md5('7|' || doc_id), 1, 13) AS BIGINT) / pow(2, 52) AS u FROM documents
), counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) AS n
  FROM draws d JOIN cdf ON cdf.s = coalesce(d.source, '') AND cdf.c <= d.u GROUP BY ALL
)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
  CAST('0x' || substr(md5('order 7|' || doc_id || '|' || copy), 1, 15) AS BIGINT) AS shuffle_key
FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM counted)
"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents")).drop("text", "rejected_by")


#: Bounds of the rules as in the cascade; the words of repeated windows are counted once each.
QUALITY_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), windows AS (
  SELECT doc_id, i, words[i:i + 2] AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs)
), repeated AS (
  SELECT doc_id, w FROM windows GROUP BY ALL HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows JOIN repeated USING (doc_id, w)) GROUP BY 1
), counted AS (
  SELECT doc_id, text, words, lines, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - list_unique(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, length(regexp_replace(text, '\P{L}', '', 'g')) AS letters, length(regexp_replace(text, '\P{Lu}', '', 'g')) AS capitals,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\s\x0B]*$'))) AS cut, len(list_filter(lines, lambda x: regexp_matches(x, '^[\s\x0B]*[-*•][\s\x0B]'))) AS bullets
  FROM docs LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols / n_words > 0.3 OR word_chars / n_words NOT BETWEEN 2 AND 15 OR n_dup_lines / len(lines) > 0.5
    OR list_unique(words) * list_unique(words) < 2.25 * n_words OR letters / word_chars < 0.6 OR capitals / greatest(letters, 1) > 0.6
    OR cut / len(lines) > 0.5 OR bullets / len(lines) > 0.9) AS kept
FROM judged
"""


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base, own = F.col("places.label"), F.col("detections.label")
    starts = F.col("places.first_word")
    strongest = F.coalesce(F.array_max(F.col("detections.priority")), F.lit(0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        (F.greatest(strongest, F.when(F.size("places") > 0, 60).otherwise(0)) / 100).cast("double").alias("score"),
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = r"\### Assistant: </turn> ok"
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(marks).alias("text")
    )
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back(format_conversations(given.unionByName(added))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), safe AS (
  SELECT *, regexp_replace(role, '<(\\*)(/?turn|text)>', '<\\\1\2>', 'g') AS safe_role,
    regexp_replace(text, '<(\\*)(/?turn|text)>', '<\\\1\2>', 'g') AS safe_text FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<turn>' || safe_role || '<text>' || safe_text || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM safe GROUP BY conv_id
"""


#: The end id of the token files.
END_ID = 2


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    parts = write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return read_token_files(spark, folder, parts).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


#: Links from all pairs of documents that share a shingle.
NEAR_DOCUMENTS_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, coalesce(max(z.n), 0) AS n_shingles, min(other) AS component_id, r.doc_id = min(other) AS kept
FROM reached r LEFT JOIN sizes z ON z.doc_id = r.doc_id GROUP BY r.doc_id
"""


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after personal data is scrubbed from each document."""
    counted = count_after_edits(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_tokens", "n_edits", "n_tokens_after", "reencoded_chars", F.size("leaf_starts").cast("long").alias("n_leaves"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit_toxicity(documents, table(spark, sf_dir, "labels"))
    return score_toxicity(documents, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's deviation is a wide decimal; here a long, null where none holds it."""
    found = whitened_embeddings(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


#: The crc32 of a decimal id bit by bit; prefixes as strings of digests; subtrees by the prefixes of each node's smallest member.
PREFIX_TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, own, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
      list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, e: xor(xor(a, e) >> 1, 3988292384 * (xor(a, e) & 1)))) % 6 AS h
  FROM (SELECT conv_id, count(*) AS own FROM turns GROUP BY conv_id)
), rebuilt AS (
  SELECT c.conv_id, t.pos AS depth, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, t.pos - c.h + least(c.h, coalesce(b.own, 0)), t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h LEFT JOIN convs b ON b.conv_id = c.base
), paths AS (
  SELECT conv_id, depth, length(text) AS chars,
    string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM rebuilt UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved FROM paths GROUP BY path, depth
), ends AS (
  SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, path, depth, max(depth) OVER (PARTITION BY conv_id) AS total FROM paths) WHERE depth = total GROUP BY path
), linked AS (
  SELECT n.*, up.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN nodes up ON up.path = p.path
), children AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL
), subtrees AS (
  SELECT p.path, sum(n.saved) AS saved_tokens, count(*) FILTER (c.n_children IS NULL) AS n_leaves
  FROM nodes n LEFT JOIN children c USING (conv_id, depth) JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.path
)
SELECT l.conv_id, CAST(l.depth AS BIGINT) AS depth, l.parent_conv_id, l.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM linked l LEFT JOIN children c USING (conv_id, depth) JOIN subtrees s USING (path) LEFT JOIN ends e USING (path)
"""


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


NEAR_VECTORS_SQL = """
WITH RECURSIVE fine AS (
  SELECT vec_id, label, v FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL)
  WHERE len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(v, lambda c: c <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = r.vec_id) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reached r GROUP BY vec_id
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_source_mixing": op3_source_mixing,
    "op4_quality_rules": op4_quality_rules,
    "op5_license_scan": op5_license_scan,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_token_files": op7_token_files,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_conversation_prefix_trie": op12_conversation_prefix_trie,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": LINE_DEDUP_SQL,
    "op3_source_mixing": MIXING_SQL,
    "op4_quality_rules": QUALITY_SQL,
    "op6_chat_formatting": CHAT_SQL,
    "op8_minhash_near_dedup": NEAR_DOCUMENTS_SQL,
    "op12_conversation_prefix_trie": PREFIX_TRIE_SQL,
    "op13_embedding_near_dedup": NEAR_VECTORS_SQL,
}
