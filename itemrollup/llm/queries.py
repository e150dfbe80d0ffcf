"""The registered queries of the operators: thin, whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .collocations import collocations
from .common import prepare, table
from .decontaminate import decontaminate
from .filter_audit import filter_audit
from .lang_id import language_id
from .near_dups import near_duplicates
from .packing import pack
from .quality_rules import quality_rules
from .quality_trees import quality_classifier
from .secret_scan import scan
from .sharding import shard_documents
from .sql import ORACLE_SQL
from .substring_dedup import dedup_substrings
from .token_counts import build, count_tokens, load_pieces
from .url_filter import filter_urls


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return count_tokens(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language_id(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dedup_substrings(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return scan(table(spark, sf_dir, "documents"))


def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack(table(spark, sf_dir, "documents"), automaton=build(load_pieces()))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_secret_scan": op7_secret_scan,
    "op8_near_dups": op8_near_dups,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_url_filter": op11_url_filter,
    "op12_filter_audit": op12_filter_audit,
    "op13_collocations": op13_collocations,
}
__all__ = ["QUERIES", "ORACLE_SQL"]
