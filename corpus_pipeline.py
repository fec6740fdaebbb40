"""A corpus from raw documents to packed sequences, in stages of the training-data operators.

Every stage reads what the one before has written. All but the last return the columns of
``documents``; the last returns the layout of the packed sequences.

Defined results, of every stage: an empty table gives an empty table; null texts are empty ones, and rows
with null or empty texts stay (the last stage gives each its end id); rows without an id, and repeated ids,
are documents of their own, but for the near-duplicate stage, where rows that share an id and a set of shingles
are one document; columns beyond those of ``documents`` are kept by the filters, whatever their names, and
ignored by packing; texts of any length are treated whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxelweave.llm import common, decontamination, minhash, packing, suffix_dedup, toxicity


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier calls toxic go; without labels the fixed lexicon and the patterns decide."""
    return toxicity.keep_clean(docs, common.table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, a similarity of 0.8 or more) the document with the smallest id stays.

    Texts without words, and rows without an id, have no copies; all of them stay.
    """
    return minhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur more than once are cut out; a document of which nothing is left goes, one that was empty stays."""
    return suffix_dedup.remove(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out, documents of which more than half the words are such go; an empty benchmark cuts nothing."""
    return decontamination.remove(docs, common.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents, with their sequence and offset; an empty document is its end id."""
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", one_of_near_copies),
    ("suffix_dedup", without_repeats),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: The classifier and the tokenizer have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
