"""Projection scans that are split over block files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names


def frame_counts(blocks: DataFrame) -> DataFrame:
    """Frames and kind of each scan; the first block by number that has a key decides."""
    known = F.when(F.col("image_key").isNotNull(), F.col("block"))
    out = blocks.groupBy("scan").agg(F.sum("frame_count").alias("frames"), F.count(F.lit(1)).alias("blocks"), F.min_by("image_key", known).alias("image_key"))
    return out.withColumn("kind", names.scan_kind(F.col("image_key")))


def block_offsets(blocks: DataFrame) -> DataFrame:
    """Global index [first, last) of each block's frames."""
    order = Window.partitionBy("scan").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    rows = blocks.withColumn("last", F.sum("frame_count").over(order))
    return rows.withColumn("first", F.col("last") - F.col("frame_count"))


def locate(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (scan, frame_index): the block that holds the frame and its place there; indices beyond a scan have no row."""
    places = block_offsets(blocks).select("scan", "block", "first", "last")
    hit = (F.col("frame_index") >= F.col("first")) & (F.col("frame_index") < F.col("last"))
    return wanted.join(places, "scan").where(hit).select("scan", "frame_index", "block", (F.col("frame_index") - F.col("first")).alias("frame_in_block"))


def latest_projection(scans: DataFrame) -> DataFrame:
    """The scan of the highest number of each kind; frame_counts gives scans."""
    return scans.groupBy("kind").agg(F.max("scan").alias("scan"))


def refusal(scan: Column, kind: Column) -> Column:
    """Why a scan can't be shown as a projection, null if it can."""
    return F.when(kind != "projection", F.concat(scan.cast("string"), F.lit(" is a "), kind, F.lit(" scan; only projections can be shown")))


def required_projection(scans: DataFrame, scan: int) -> DataFrame:
    """The row of a scan, which has to be there and hold projections."""
    rows = scans.where(F.col("scan") == scan)
    found = rows.select(refusal(F.col("scan"), F.col("kind")).alias("why")).head()
    if found is None or found.why:
        raise ValueError(found.why if found else f"no scan {scan}")
    return rows
