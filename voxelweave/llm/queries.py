"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, compression, decontamination, metric_search, minhash, packing, suffix_dedup, token_counts, toxicity, url_rules, warc
from .common import new_path, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op4_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compression.score(docs, compression.fit(docs, table(spark, sf_dir, "labels")))


def op5_metric_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(*extra.columns).unionByName(extra)
    return chat.digest(chat.expand(turns))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.digest(found)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    index = warc.write(table(spark, sf_dir, "pages"), folder)
    found = warc.read(index, folder)
    return found.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_toxicity, op2_best_fit_packing, op3_near_duplicates, op4_quality_compression, op5_metric_search, op6_suffix_dedup, op7_chat_formatting, op8_url_rules, op9_decontamination, op10_warc, op11_token_counts, op12_centroid_clusters)}
