"""A training corpus from raw documents: language, toxicity, near-duplicates, mixture, token ids.

Each stage takes (spark, documents, folder of the tables) and returns documents with the same columns, the last one their
encodings. Every stage works on all that the one before kept. Filters keep rows they know nothing against; repeated rows are
treated alike until near-duplicates are taken out; null texts have no language and go in the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bureaulake.llm import bpe, langid, minhash, mixing, toxicity
from bureaulake.llm.common import fold, stored, table
from bureaulake.llm.queries import MIX


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are in none of the languages labelled in the training fold go."""
    return langid.accepted(docs, langid.fit(docs, fold("doc_id", 5) != 0))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a window predicted toxic go."""
    model, share = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return toxicity.clean(docs, model, share)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that share 80 % of their five-word shingles, that with the smallest doc_id stays."""
    return minhash.one_of_each(docs, size=5, threshold=0.8)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with target shares of languages and tempered sources and topics."""
    return mixing.sample(docs, MIX)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of the token ids of each text, and of the bytes decoded from them."""
    return bpe.round_trip(docs, bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


STAGES = [("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("mixture", mixture), ("token_ids", token_ids)]

#: SQL can't express trained classifiers; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
