"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, fill_middle, language_id, license_scan, lm_scoring, mixing, packing, quality_rules, simhash, token_files, url_filters, whitening
from .common import documents, embeddings, pages


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir).select("doc_id", "text", "lang"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages(spark, sf_dir).select("page_id", "url")
    return url_filters.judge_urls(rows, url_filters.listed_keys(rows)).select("page_id", "host", "path", "rule", "verdict")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encoded(documents(spark, sf_dir), with_ids=False)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "source", "text"), mixing.TARGETS, others=1.0)
    return mixed.withColumn("mix_key", F.round("mix_key", 9))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir)).drop("n_chars")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    there_and_back = bpe.decode(bpe.encode(documents(spark, sf_dir)))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return there_and_back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), sha(ids).alias("ids_sha256"), sha(F.col("decoded")).alias("decoded_sha256"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.restore(fill_middle.transform(documents(spark, sf_dir)))
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output").alias("output_sha256"), sha("text").alias("restored_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(embeddings(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_lm_scoring, op3_language_id, op4_url_filters, op5_simhash, op6_license_scan, op7_token_files, op8_mixing, op9_packing, op10_exact_dedup, op11_bpe, op12_fill_middle, op13_whitening)
}
ORACLES = {
    "op1_quality_rules": quality_rules.ORACLE_SQL,
    "op4_url_filters": url_filters.ORACLE_SQL,
    "op8_mixing": mixing.ORACLE_SQL,
    "op10_exact_dedup": exact_dedup.ORACLE_SQL,
    "op12_fill_middle": fill_middle.ORACLE_SQL,
}
