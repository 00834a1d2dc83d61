"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import bpe, html_extract, line_dedup, mixing, oracles, quality, simhash, spotsigs, toxicity, url_filter, warc
from feedmill.runtime import read_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(read_table(spark, sf_dir, "pages"))


def op2_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_likeness(read_table(spark, sf_dir, "documents"))


def op4_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"))


def op5_two_tier_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=False
    )


def op6_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    # which rule came first depends on measured costs; the verdict doesn't
    return quality.judge_quality(read_table(spark, sf_dir, "documents")).drop("rejected_by")


def op7_block_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op8_segment_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(read_table(spark, sf_dir, "documents")).drop("h")


def op9_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_bloom_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), url_filter.default_entries(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_tag_path_ratios, op2_pivot_simhash, op3_spotsigs, op4_warc_boundary_chain, op5_two_tier_bpe, op6_rule_cascade,
        op7_block_mix, op8_segment_edit_join, op9_weak_toxicity, op10_bloom_url_filter,
    )
}

ORACLES: dict[str, str] = {"op4_warc_boundary_chain": oracles.WARC, "op6_rule_cascade": oracles.QUALITY, "op10_bloom_url_filter": oracles.URLS}
