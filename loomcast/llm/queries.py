"""The registered queries of this package and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomcast.llm.common import table
from loomcast.llm.decontaminate import DecontaminateSettings, contamination
from loomcast.llm.language_id import identify_languages
from loomcast.llm.license_scan import LicenseSettings, scan_licenses, template_sets
from loomcast.llm.mixing import MixSettings, mixture
from loomcast.llm.near_dup import NearDupSettings, near_duplicates
from loomcast.llm.oracle import (
    contamination_sql,
    license_sql,
    mixing_sql,
    near_duplicates_sql,
    ranked_search_sql,
    sharding_sql,
    spelling_sql,
    top_k_sql,
)
from loomcast.llm.pii import personal_data
from loomcast.llm.quality import quality_scores
from loomcast.llm.ranked_search import SearchSettings, ranked_search
from loomcast.llm.sharding import ShardSettings, shard_assignment
from loomcast.llm.simhash import SimHashSettings, simhash_groups
from loomcast.llm.spelling import SpellingSettings, spelling_variants
from loomcast.llm.token_files import TokenFileSettings, token_files
from loomcast.llm.topk import TopKSettings, top_k


def op1_super_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearDupSettings(width=2))


def op2_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), LicenseSettings())


def op3_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_assignment(table(spark, sf_dir, "documents"), ShardSettings(shards=16))


def op5_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"), MixSettings())


def op6_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op7_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, x) for x in ("documents", "benchmark"))
    return contamination(documents, benchmark, DecontaminateSettings(window=13, share=20))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = TokenFileSettings(public_tokenizers.path("byte_bpe_50k.json"))
    return token_files(table(spark, sf_dir, "documents"), settings)


def op9_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), TopKSettings(k=5, every=50))


def op10_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op11_hybrid_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, x) for x in ("documents", "benchmark"))
    return ranked_search(documents, benchmark, SearchSettings(k=50))


def op12_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), SimHashSettings(width=3))


def op13_trie_frontier_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), SpellingSettings())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_super_minhash_dedup": op1_super_minhash_dedup,
    "op2_license_dice": op2_license_dice,
    "op3_ftrl_quality": op3_ftrl_quality,
    "op4_stratified_shards": op4_stratified_shards,
    "op5_temperature_mix": op5_temperature_mix,
    "op6_weak_supervision_pii": op6_weak_supervision_pii,
    "op7_winnowing_decontamination": op7_winnowing_decontamination,
    "op8_token_files": op8_token_files,
    "op9_threshold_top_k": op9_threshold_top_k,
    "op10_kneser_ney_language": op10_kneser_ney_language,
    "op11_hybrid_ranked_search": op11_hybrid_ranked_search,
    "op12_golay_simhash": op12_golay_simhash,
    "op13_trie_frontier_spelling": op13_trie_frontier_spelling,
}

ORACLE: dict[str, str] = {
    "op1_super_minhash_dedup": near_duplicates_sql(width=2),
    "op2_license_dice": license_sql(template_sets(LicenseSettings()), LicenseSettings().threshold),
    "op4_stratified_shards": sharding_sql(shards=16),
    "op5_temperature_mix": mixing_sql(entropy=0.998, max_epochs=2.0),
    "op7_winnowing_decontamination": contamination_sql(window=13, share=20),
    "op9_threshold_top_k": top_k_sql(k=5, every=50),
    "op11_hybrid_ranked_search": ranked_search_sql(k=50),
    "op13_trie_frontier_spelling": spelling_sql(
        min_length=7, min_count=2, typo_every=31, ratio=10
    ),
}
