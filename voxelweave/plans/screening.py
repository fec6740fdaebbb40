"""Frames of volume series: raw planes for screening, and planes beside their differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, scalars
from ..operators import frames, slices
from ..sources import volumes
from ..storage import few, materialize
from .tracking import Crop

Centre = tuple[int, int, int]
KEY = ["series", "plane", "seq"]


def planes_in_crop(tiles: DataFrame, centre: Centre, crop: Crop = Crop(), step: int = 1, fast: bool = False) -> DataFrame:
    """(series, seq, plane, y, x, v): the planes through a centre of the crop, every step-th value of each axis.

    Centre, coordinates and steps count from the crop's start.
    """
    cropped = volumes.crop_tiles(tiles, crop.z, crop.y, crop.x)
    rows = slices.pixels(slices.cut_planes(cropped, centre, fast), "data").withColumnRenamed("data", "v")
    if step == 1:
        return rows
    rows = rows.where((F.col("y") % step == 0) & (F.col("x") % step == 0))
    return rows.withColumns({a: F.floor(F.col(a) / step).cast("int") for a in ("y", "x")})


def raw_frames(tiles: DataFrame, centre: Centre, fast: bool = False, **limits) -> DataFrame:
    """Normalised orthogonal planes of every member, each by its own range unless both limits are given."""
    planes = slices.pixels(slices.cut_planes(tiles, centre, fast), "data").withColumnRenamed("data", "v")
    return frames.normalised_frames(planes, KEY, **limits)


def comparison_frames(tiles: DataFrame, centre: Centre, floor: float = 0.0, fast: bool = False, span: float | None = None, gap: int = 4) -> DataFrame:
    """Each member's plane, and beside it the difference from the member before without what is under floor.

    span is the symmetric range of differences; without it they are scaled by percentiles. gap white columns lie between.
    Planes are cut from the tiles before anything else, so only they are compared; both halves of a frame
    come from one pass, and its width from the metadata of its parts.
    """
    cut = slices.cut_planes(tiles, centre, fast)
    order = Window.partitionBy("series", "plane", "row", "col", "width").orderBy("seq")
    both = cut.withColumn("before", F.lag("data").over(order)).where("before is not null")
    change = F.zip_with("data", "before", lambda a, b: scalars.deadband((a - b).cast("float").cast("double"), floor))
    both = materialize(both.withColumn("change", change).drop("before"), "planes")
    wide = both.groupBy(*KEY).agg(F.max(F.col("col") + F.col("width")).alias("wide"))
    rows = slices.pixels(both, "data", "change").withColumns({"data": F.col("data").cast("double")})
    rows = rows.join(few(wide), KEY)
    rows = rows.join(few(_range(rows, "data", None)), KEY).join(few(_range(rows, "change", span)), KEY)
    left = F.struct(F.col("x").alias("x"), scalars.normalised_frame(F.col("data"), F.col("data_low"), F.col("data_high")).alias("v"))
    right = F.struct((F.col("x") + F.col("wide") + gap).alias("x"), scalars.normalised_frame(F.col("change"), F.col("change_low"), F.col("change_high")).alias("v"))
    white = F.transform(F.sequence(F.lit(0), F.lit(gap - 1)), lambda i: F.struct((F.col("wide") + i).cast("int").alias("x"), F.lit(1.0).alias("v")))
    here = F.concat(F.array(left, right), F.when(F.col("x") == 0, white).otherwise(F.slice(white, 1, 0))) if gap else F.array(left, right)
    return rows.select(*KEY, "y", F.explode(here).alias("p")).select(*KEY, "y", "p.x", "p.v")


def _range(rows: DataFrame, value: str, span: float | None) -> DataFrame:
    limits = {} if span is None else {"low": -span, "high": span}
    found = frames.display_range(rows.select(*KEY, F.col(value).alias("v")), KEY, **limits)
    return found.withColumnsRenamed({"low": f"{value}_low", "high": f"{value}_high"})


def labels(pairs: DataFrame) -> DataFrame:
    """The caption of each frame: its number and that of the member before."""
    return pairs.select("series", "seq", names.frame_label(F.col("seq"), F.col("prev_seq")).alias("label")).distinct()


def raw_only(gif_only: bool, mode: str) -> bool:
    """Whether raw frames are all that is wanted, so that nothing is compared."""
    return gif_only and mode == "raw"
