"""One registered query per operator, with production parameters over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, conversations, decontam, langid, mixing, pii, qda, quality, secrets, simhash, spans, tokens, toxicity, urls
from .common import sha256_of, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        sha256_of(F.array_join("items", ",")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.digest(secrets.secrets(table(spark, sf_dir, "documents")), secrets.BASE_KINDS)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = tokens.counted(tokens.number_edits(table(spark, sf_dir, "documents")))
    return tokens.edited(tokens.revision_edits(state)).select("doc_id", "n_tokens_before", "n_edits", "n_tokens", "n_encoded")


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.digest(pii.personal(table(spark, sf_dir, "documents")), pii.BASE_KINDS)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op11_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qda.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(table(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damaged(table(spark, sf_dir, "conversations")), copies="copies")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_secrets": op2_secrets,
    "op3_simhash": op3_simhash,
    "op4_tokens": op4_tokens,
    "op5_mix": op5_mix,
    "op6_pii": op6_pii,
    "op7_language": op7_language,
    "op8_urls": op8_urls,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_classifier": op11_classifier,
    "op12_collocations": op12_collocations,
    "op13_conversations": op13_conversations,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": decontam.ORACLE,
    "op5_mix": mixing.ORACLE,
    "op8_urls": urls.ORACLE,
    "op10_quality": quality.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_conversations": conversations.ORACLE,
}
