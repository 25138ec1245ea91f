"""Corpus pipeline over ``documents``: every stage works on all that the one before it kept.

quality classifier (rejected documents go) -> line dedup (lines of ten and more documents go) ->
MinHash near-dedup (one document of each group stays) -> mixing sources to target weights (documents
are repeated or left out) -> byte-level BPE (token ids, checked by decoding them again).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import byte_bpe, line_dedup, minhash_forest, mixing, quality
from ledgerflow.llm.common import stored, table
from ledgerflow.llm.queries import tokenizer_file


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def without_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs).drop(*line_dedup.counts(docs))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_forest.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = tokenizer_file("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [("quality", good_documents), ("line dedup", without_frequent_lines),
          ("near dedup", without_near_duplicates), ("mixing", mixed_sources),
          ("byte bpe", token_ids)]

# The classifier and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = stored(docs, f"stage{n}")
    return docs
