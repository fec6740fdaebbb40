"""Connected components of link tables, in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import few, materialize


def roots(links: DataFrame, key: list[str]) -> DataFrame:
    """(key, id, root) of every id in links (key, a, b): the smallest id that it reaches. Ids of different keys are different.

    A round takes the smallest root among an id and its neighbours, then that one's own root; it ends when
    no root changes. Roots are written each round, so the plan never grows and a lost executor costs a round.
    """
    both = links.unionByName(links.select(*key, F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialize(both, "links")
    found = materialize(both.groupBy(*key, F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("root")), "roots")
    while True:
        known = few(found)
        of_root = known.select(*key, F.col("id").alias("root"), F.col("root").alias("further"))
        own = found.join(of_root, [*key, "root"]).select(*key, "id", F.col("root").alias("old"), F.least("root", "further").alias("new"))
        of_b = known.select(*key, F.col("id").alias("b"), F.col("root").alias("new"))
        around = both.join(of_b, [*key, "b"]).select(*key, F.col("a").alias("id"), F.lit(None).cast("bigint").alias("old"), "new")
        after = own.unionByName(around).groupBy(*key, "id").agg(F.max("old").alias("old"), F.min("new").alias("root"))
        after = materialize(after, "roots")
        found = after.drop("old")
        if after.where("old <> root").isEmpty():
            return found
