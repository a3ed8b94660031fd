"""Queries of the training-data operators and their SQL.

Each query applies one operator, with production parameters, to its whole
table and returns the full result.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import table
from ferry.llm.op1_embeddings import near_vectors
from ferry.llm.op2_html import extract_pages
from ferry.llm.op3_quality import (BOILERPLATE, CLOSED, SENTENCE_END, SEPARATOR, SHORT_LINE,
                                   SHOUT, SYMBOL, quality_rules)
from ferry.llm.op4_mixing import mix_documents
from ferry.llm.op5_sentencepiece import encode_documents
from ferry.llm.op6_pii import personal_data
from ferry.llm.op7_minhash import near_duplicates
from ferry.llm.op8_records import read_records, write_records
from ferry.llm.op9_license import (ANY_HOLDER, ANY_TAG, COMMENT, HEADER_RULES, HEADERS, HOLDER,
                                   MARKS, NOISE, RULES, SENTENCE_BREAK, SENTENCES, TAG,
                                   license_scan)
from ferry.llm.op10_lines import line_report
from ferry.llm.op11_negatives import hard_negatives
from ferry.llm.op12_alignment import align_documents
from ferry.llm.op13_sharding import shard_documents

# Production parameters of the mix, and the id that ends a document.
MIX = {"target_entropy": 0.92, "max_repetition": 2.0, "seed": 7}
END_ID = 2


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_documents(docs, **MIX).select("doc_id", "source", "block", "order_key")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"),
                            tokenizer_path("piece_bpe_32k.model"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_records(table(spark, sf_dir, "documents"),
                             tokenizer_path("word_bpe_49k.json"), END_ID)
    return read_records(spark, manifest)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"),
                           tokenizer_path("byte_bpe_50k.json"),
                           tokenizer_path("piece_bpe_32k.model"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), n_shards=40)


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# A phrase between characters that no word holds. DuckDB has no look-behind, so
# those are doubled in the line first, and two phrases can share one.
DOUBLED = (r"(?i)(?:^|[^\p{L}\p{M}\p{N}_-])("
           + "|".join(re.sub(r"([^\w-])", r"\1\1", p) for p in BOILERPLATE)
           + r")(?:[^\p{L}\p{M}\p{N}_-]|$)")

OP3_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT row_no, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
win AS (
  SELECT row_no, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT row_no, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w)),
again AS (
  SELECT row_no, i, count(*) OVER (PARTITION BY row_no, gram) AS n FROM win),
covered AS (
  SELECT row_no, count(DISTINCT spot) AS n FROM (
    SELECT row_no, i + unnest([0, 1, 2]) AS spot FROM again WHERE n > 1) GROUP BY row_no),
lines AS (
  SELECT row_no, line,
    (NOT regexp_matches(line, {_sql(CLOSED)}) AND NOT regexp_matches(line, {_sql(SENTENCE_END)}))
    OR len(regexp_extract_all(line, {_sql(SYMBOL)})) * 10 > length(line)
    OR len(regexp_extract_all(line, {_sql(SHOUT)})) * 30 > length(line)
    OR (len(regexp_extract_all(line, {_sql(SEPARATOR)})) >= 2
        AND len(regexp_extract_all(line, {_sql(SEPARATOR)})) * 30 > length(line))
    OR (len(phrases) > 0
        AND (len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) <= {SHORT_LINE}
             OR list_sum(list_transform(phrases, lambda x: length(replace(x, '  ', ' ')))) * 2
                >= length(line))) AS fails
  FROM (SELECT row_no, line, regexp_extract_all(
          regexp_replace(line, '([^\\p{{L}}\\p{{M}}\\p{{N}}_-])', '\\1\\1', 'g'),
          {_sql(DOUBLED)}, 1) AS phrases
        FROM (SELECT row_no, unnest(string_split(text, chr(10))) AS line FROM d))
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
l AS (
  SELECT row_no, count(*) - count(DISTINCT line) AS n_dup_lines, sum(length(line)) AS line_chars,
    coalesce(sum(length(line)) FILTER (WHERE fails), 0) AS lost_chars
  FROM lines GROUP BY row_no),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(l.n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lost_chars, 0) AS lost_chars, coalesce(line_chars, 0) AS line_chars
  FROM w LEFT JOIN l USING (row_no) LEFT JOIN covered USING (row_no))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AS base_failed,
  NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50)
    AND lost_chars <= line_chars * 0.5 AS kept
FROM m
"""

OP4_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
  FROM documents),
src AS (
  SELECT source, sum(tokens)::DOUBLE AS tokens, sum(sum(tokens)) OVER ()::DOUBLE AS total
  FROM d GROUP BY source),
share AS (SELECT tokens / total AS p FROM src WHERE tokens > 0),
bisect(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN h >= aim THEN mid ELSE lo END, CASE WHEN h >= aim THEN hi ELSE mid END
  FROM (SELECT i, any_value(lo) AS lo, any_value(hi) AS hi, any_value(mid) AS mid,
          ln(sum(p ** mid)) - any_value(mid) * sum(p ** mid * ln(p)) / sum(p ** mid) AS h,
          {MIX["target_entropy"]} * ln(count(*)) - 1e-12 AS aim
        FROM (SELECT *, CASE WHEN i = 0 THEN 1.0 ELSE (lo + hi) / 2 END AS mid FROM bisect) b, share
        WHERE i < 50 GROUP BY i) x),
a AS (
  SELECT round(greatest(
    (SELECT lo FROM bisect ORDER BY i DESC LIMIT 1),
    (SELECT CASE WHEN max(p) / min(p) > {MIX["max_repetition"]}
       THEN 1 - ln({MIX["max_repetition"]}) / ln(max(p) / min(p)) ELSE 0 END FROM share)), 6) AS a),
scaled AS (SELECT source, tokens, (tokens / total) ** a AS s FROM src, a WHERE tokens > 0),
plan AS (
  SELECT source, tokens, round(s / sum(s) OVER () * (max(tokens / s) OVER () * sum(s) OVER ()))::BIGINT
    AS quota FROM scaled),
cut AS (
  SELECT source, quota // tokens::BIGINT AS whole, quota % tokens::BIGINT AS rest FROM plan
  UNION ALL SELECT source, 1, 0 FROM src WHERE tokens = 0),
keyed AS (
  SELECT doc_id, d.source, tokens, whole, rest,
    md5('{MIX["seed"]}:' || whole || ':' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM d JOIN cut ON d.source IS NOT DISTINCT FROM cut.source),
placed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY k
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed)
SELECT doc_id, source, block, md5('{MIX["seed"]}:' || block || ':' || coalesce(doc_id::VARCHAR, ''))
  AS order_key
FROM (SELECT doc_id, source,
        unnest(range(0, whole + CASE WHEN rest > 0 AND before < rest THEN 1 ELSE 0 END)) AS block
      FROM placed)
"""


def _op9_sql() -> str:
    wordings = HEADERS | {v: k for k, v in SENTENCES.items()}
    known = ", ".join(f"({_sql(v)}, {_sql(k)})" for v, k in wordings.items())
    # Rules one after the other; what a rule matched is gone for the next.
    steps, names = [], []
    for n, (name, seq) in enumerate(HEADER_RULES + RULES):
        chain = _sql("".join(f"<{x}>" for x in seq))
        steps.append(f"replace(c{n}, {chain}, '|') AS c{n + 1}")
        names.append(f"CASE WHEN contains(c{n}, {chain}) THEN {_sql(name)} END")
    marked = " OR ".join(f"contains(body, {_sql(m)})" for m in MARKS)
    return f"""
WITH known(norm, sentence_id) AS (VALUES {known}),
docs AS (
  SELECT DISTINCT doc_id, CASE WHEN doc_id IS NULL THEN body ELSE '' END AS own, body
  FROM (SELECT doc_id, lower(coalesce(text, '')) AS body FROM documents)),
pieces AS (
  SELECT doc_id, own, unnest(range(len(l))) AS pos, unnest(l) AS piece
  FROM (SELECT doc_id, own, regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(
          body, {_sql(COMMENT)}, '', 'g'), {_sql(HOLDER)}, {_sql(ANY_HOLDER)}, 'g'),
          {_sql(TAG)}, {_sql(ANY_TAG)}, 'g'), {_sql(SENTENCE_BREAK)}) AS l
        FROM docs WHERE {marked})),
parts AS (
  SELECT doc_id, own, pos, unnest(range(len(l))) AS sub, unnest(l) AS sentence
  FROM (SELECT doc_id, own, pos, CASE WHEN contains(piece, chr(10))
          THEN list_concat([piece], string_split(piece, chr(10))) ELSE [piece] END AS l
        FROM pieces)),
hits AS (
  SELECT doc_id, own, pos, sub, sentence_id
  FROM (SELECT *, regexp_replace(trim(regexp_replace(sentence, {_sql(NOISE)}, ' ', 'g')),
                                 '\\.+$', '') AS norm FROM parts) JOIN known USING (norm)),
marked AS (
  SELECT *, lag(pos) OVER w IS NOT DISTINCT FROM pos
    AND lag(sentence_id) OVER w IS NOT DISTINCT FROM sentence_id AS again
  FROM hits WINDOW w AS (PARTITION BY doc_id, own ORDER BY pos, sub)),
found AS (
  SELECT doc_id, own, list(sentence_id ORDER BY pos, sub) AS sentence_ids,
    coalesce(string_agg('<' || sentence_id || '>', '' ORDER BY pos, sub)
      FILTER (WHERE NOT again), '') AS c0
  FROM marked GROUP BY doc_id, own),
chains AS (SELECT *, {", ".join(steps)} FROM found),
matched AS (
  SELECT doc_id, own, sentence_ids,
    list_filter([{", ".join(names)}], lambda x: x IS NOT NULL) AS l FROM chains)
SELECT d.doc_id, coalesce(sentence_ids, []) AS sentence_ids,
  coalesce(list_filter(l, lambda x, i: list_position(l, x) = i), []) AS licenses
FROM (SELECT DISTINCT doc_id, own FROM docs) d
LEFT JOIN matched m ON d.doc_id IS NOT DISTINCT FROM m.doc_id AND d.own = m.own
"""


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row_no, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT a.row_no AS anchor, a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
    list_dot_product(a.q, v.q)::BIGINT AS score
  FROM a JOIN v ON a.row_no <> v.row_no AND len(a.q) = len(v.q)),
p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
  FROM s WHERE same QUALIFY place <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
    s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same
    AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_quality_rules": op3_quality_rules,
    "op4_source_mixing": op4_source_mixing,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_personal_data": op6_personal_data,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_binary_records": op8_binary_records,
    "op9_license_scan": op9_license_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_alignment": op12_alignment,
    "op13_sharding": op13_sharding,
}

ORACLE = {
    "op3_quality_rules": OP3_SQL,
    "op4_source_mixing": OP4_SQL,
    "op9_license_scan": _op9_sql(),
    "op11_hard_negatives": OP11_SQL,
}
