"""Connected components of link tables, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every id in links (a, b): root is the smallest id that it reaches.

    Each round takes the smallest label among neighbours and then follows labels of labels; it ends
    when no label changes. Labels live in the shared folder, so every round starts from files.
    """
    both = common.materialize(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = common.materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("root")), "labels")
    while True:
        known = common.small(labels)
        jump = labels.join(known.select(F.col("id").alias("root"), F.col("root").alias("further")), "root").select("id", F.col("root").alias("old"), F.least("root", "further").alias("root"))
        own = jump.select("id", "old", F.col("root").alias("near"))
        near = both.join(known.select(F.col("id").alias("b"), F.col("root").alias("near")), "b").select(F.col("a").alias("id"), F.lit(None).cast("bigint").alias("old"), "near")
        labels = common.materialize(own.unionByName(near).groupBy("id").agg(F.max("old").alias("old"), F.min("near").alias("root")), "labels")
        if labels.where("root <> old").isEmpty():
            return labels
