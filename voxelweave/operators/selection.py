"""Exact order statistics by repeated counting, without a table of all values.

A wanted rank lies in a range of values, at first the whole range of its group. Each round counts the values
of every open range in bins, finds the bin that holds the rank, and goes on with the least and the greatest value
there; it ends when these are one. State is a row for each bin, whatever the number of values; the
values are read again each round. The bin of a value never falls as the value grows, so ranks are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import few, materialize
from .diff import NORMAL_QUARTILE

BINS = 4096
#: Stands for infinity: beyond every float, and differences of such values are finite.
_FAR = 1e39


def _bounded(v: Column) -> Column:
    return F.greatest(F.least(v.cast("double"), F.lit(_FAR)), F.lit(-_FAR))


def order_statistics(values: DataFrame, by: list[str], ranks: DataFrame, bins: int = BINS) -> DataFrame:
    """(by, rank, v): the value of each rank (by, rank; 0 is the least value) of its group.

    values: (by, v); nulls and values that are no number do not count. Ranks beyond a group have no row.
    """
    some = values.where(F.col("v").isNotNull() & ~F.isnan("v")).select(*by, _bounded(F.col("v")).alias("v"))
    ends = some.groupBy(*by).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"))
    state = ranks.select(*by, "rank").distinct().join(ends, by).where((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))
    state = materialize(state.select(*by, "rank", F.col("rank").alias("left"), "low", "high"), "ranks")
    while not state.where("low < high").isEmpty():
        spans = few(state.where("low < high").select(*by, "low", "high").distinct())
        inside = some.join(spans, by).where((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))
        share = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low"))
        binned = inside.groupBy(*by, "low", "high", F.least(F.floor(share * bins), F.lit(bins - 1)).alias("bin"))
        counts = binned.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("first"), F.max("v").alias("last"))
        order = Window.partitionBy(*by, "low", "high").orderBy("bin")  # at most bins rows
        counts = counts.withColumn("before", F.sum("n").over(order) - F.col("n"))
        hit = state.join(counts, [*by, "low", "high"]).where((F.col("left") >= F.col("before")) & (F.col("left") < F.col("before") + F.col("n")))
        found = hit.select(*by, "rank", (F.col("left") - F.col("before")).alias("left"), F.col("first").alias("low"), F.col("last").alias("high"))
        state = materialize(state.where("low = high").unionByName(found), "ranks")
    at = F.when(F.abs("low") == _FAR, F.signum("low") * float("inf")).otherwise(F.col("low"))
    return state.select(*by, "rank", at.alias("v"))


def percentiles(values: DataFrame, by: list[str], shares: list[float], bins: int = BINS) -> DataFrame:
    """(by, n, p): count and the linear percentiles of each group, in the order of shares."""
    some = values.where(F.col("v").isNotNull() & ~F.isnan("v"))
    sizes = materialize(some.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), "sizes")
    at = F.array(*(F.struct(F.lit(i).alias("i"), ((F.col("n") - 1) * F.lit(float(s))).alias("at")) for i, s in enumerate(shares)))
    wanted = sizes.select(*by, "n", F.explode(at).alias("w")).select(*by, "n", "w.i", "w.at")
    low, high = F.floor("at").cast("bigint"), F.ceil("at").cast("bigint")
    ranks = wanted.select(*by, F.explode(F.array(low, high)).alias("rank"))
    found = order_statistics(values, by, ranks, bins)
    below = found.select(*by, F.col("rank").alias("_low"), F.col("v").alias("a"))
    above = found.select(*by, F.col("rank").alias("_high"), F.col("v").alias("b"))
    rows = wanted.withColumns({"_low": low, "_high": high}).join(below, [*by, "_low"]).join(above, [*by, "_high"])
    value = F.when(F.col("_low") == F.col("_high"), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.col("_low")))
    listed = F.array_sort(F.collect_list(F.struct("i", value.alias("v"))))  # one for each share
    return rows.groupBy(*by, "n").agg(F.transform(listed, lambda x: x["v"]).alias("p"))


def robust_sigma(values: DataFrame, by: list[str], bins: int = BINS) -> DataFrame:
    """``diff.robust_sigma`` of (by, v) over any number of values."""
    some = values.where(F.col("v").isNotNull() & ~F.isnan("v")).withColumn("v", F.col("v").cast("double"))
    middle = percentiles(some, by, [0.5], bins).select(*by, F.col("p")[0].alias("m"))
    spread = some.groupBy(*by).agg(F.stddev_pop("v").alias("sd"))
    away = some.join(few(middle), by).select(*by, F.abs(F.col("v") - F.col("m")).alias("v"))
    mad = percentiles(away, by, [0.5], bins).select(*by, F.col("p")[0].alias("mad"))
    return mad.join(spread, by).select(*by, F.when(F.col("mad") > 0, F.col("mad") / NORMAL_QUARTILE).otherwise(F.col("sd")).alias("sigma"))
