"""Registered queries of the operators, one per operator, and their SQL where SQL can state the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bureaulake.llm import binarycodes, bpe, huffman, langid, lattice, minhash, mixing, phrases, quality, spelling, tokencount, toxicity, warc
from bureaulake.llm.common import fold, table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold("doc_id", 5) != 0)
    return langid.predict(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, threshold=0.8)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, share = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    scored = toxicity.score(docs, model, share)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "position", "intact")


WARC_SQL = f"""
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
stands AS (SELECT payload, max(page_id) AS stands FROM payloads WHERE payload_bytes >= {warc.LEAST} GROUP BY payload),
keyed AS (
  SELECT p.*, CASE WHEN p.page_id < s.stands THEN s.stands END AS refers_to,
    CASE WHEN url IS NULL THEN '' WHEN NOT contains(url, '://') THEN url ELSE
      array_to_string(list_reverse(string_split(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '.')), ',') || ')' ||
      regexp_extract(url, '://[^/?#]*(.*)$', 1, 's') END AS url_key
  FROM payloads p LEFT JOIN stands s ON p.payload = s.payload AND p.payload_bytes >= {warc.LEAST})
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, sha1(payload) AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  refers_to, url_key, row_number() OVER (ORDER BY url_key, page_id) - 1 AS position, true AS intact
FROM keyed
"""

#: Shares that the languages shall have of the tokens; sources and topics are tempered.
MIX: dict[str, dict[str, float] | None] = {"source": None, "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}, "topic": None}


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(table(spark, sf_dir, "documents"), MIX)
    return out.withColumns({c: F.round(c, 6) for c in ("weight", "probability")})


def op8_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = lattice.read(public_tokenizers.path("piece_bpe_32k.model"))
    scored = lattice.score(table(spark, sf_dir, "documents"), fold("doc_id", 10) != 0, vocabulary)
    return scored.select("doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_binary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binarycodes.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op10_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.archive(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=2)


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), threshold=10, longest=3, top=2000, inside=50)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), least=7, often=2, every=31), factor=10)


QUERIES = {f.__name__: f for f in (op1_byte_bpe, op2_quality_rules, op3_language_id, op4_minhash_dedup, op5_toxicity, op6_warc, op7_mixing, op8_subword_lattice, op9_binary_codes, op10_huffman_ids,
                                   op11_phrase_mining, op12_token_counts, op13_spelling_variants)}
ORACLE: dict[str, str] = {"op6_warc": WARC_SQL, "op7_mixing": mixing.oracle(MIX), "op11_phrase_mining": phrases.oracle(10, 2000, 50)}
