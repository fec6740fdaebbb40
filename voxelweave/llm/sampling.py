"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Rows with longer texts do not serve for fitting (they are scored like all others).
MAX_CHARS = 100_000


def train_labels(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, label): labels 0 and 1 of rows that are not held out."""
    return common.only(labels, "doc_id", name).select(F.col("doc_id").cast("bigint"), F.col(name).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").where(~common.held_out(F.col("doc_id")))


def sample(docs: DataFrame, labels: DataFrame, name: str, rows: dict[int, int], max_chars: int = MAX_CHARS) -> DataFrame:
    """(doc_id, label, text): distinct non-null texts of at most rows[label] training rows of each label, by a hash of the id."""
    found = train_labels(labels, name).distinct()
    salted = found.withColumn("order", F.xxhash64("doc_id"))
    picked = None
    for label, most in rows.items():
        part = salted.where(F.col("label") == label).orderBy("order", "doc_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    picked = picked.select("doc_id", "label").collect()  # at most sum(rows) ids
    spark = docs.sparkSession
    ids = F.broadcast(spark.createDataFrame(picked, "doc_id bigint, label int"))
    texts = common.only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text").where("text is not null").where(F.length("text") <= max_chars)
    one = F.row_number().over(Window.partitionBy(F.xxhash64("text"), "text").orderBy("doc_id", "label"))
    return texts.join(ids, "doc_id").withColumn("nth", one).where("nth = 1").drop("nth")
