"""One query per operator over its whole table, and the same rows as DuckDB SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scrubline.llm import chat, decontaminate, disclosure, kneser_ney, line_dedup, mixing, risk_rules, shard_tree, simhash, spelling, token_shards, url_filter, whitening
from scrubline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_filter.judge(pages.select("page_id", "url"), url_filter.junk_urls(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.round_trip(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "perplexity", "threshold", "kept", "pooled")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_tree.report(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.report(table(spark, sf_dir, "documents"), disclosure.Disclosure(reach=None))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_token_id_output": op2_token_id_output,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_mixing": op6_mixing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_sharding": op9_sharding,
    "op10_quality_rules": op10_quality_rules,
    "op11_pii": op11_pii,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": url_filter.ORACLE,
    "op3_chat_formatting": chat.ORACLE,
    "op4_benchmark_decontamination": decontaminate.ORACLE,
    "op10_quality_rules": risk_rules.ORACLE,
    "op12_spelling_variants": spelling.ORACLE,
}
