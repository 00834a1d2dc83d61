"""The corpus pipeline: five stages over documents, each one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedmill.llm import bpe, line_dedup, mixing, shingles, simhash, toxicity
from feedmill.llm.components import connected_components, keep_first
from feedmill.runtime import cut, read_table

#: Block length of the mix: long enough that most documents are taken whole.
BLOCK_WORDS = 1024
#: Pre-tokens that a worker remembers: fewer than by default, as its memory has served other stages before.
REMEMBERED = 1 << 16


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2's SimHash links, each checked by Jaccard similarity, then the similar texts that 64 bits can't tell from chance."""
    return keep_first(docs, connected_components(shingles.near_links(docs, simhash.text_links(docs))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, BLOCK_WORDS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, remembered=REMEMBERED)


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("simhash_near_dedup", near_dedup), ("source_mixing", mix_sources), ("byte_bpe", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
