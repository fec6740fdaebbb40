"""The reduction plan: crop, block mean or subsample, clip, mask, and scale to bytes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..functions.ranges import check_options, target_to_source
from ..operators import slices, transform


@dataclass(frozen=True)
class Options:
    factor: int = 1
    mode: str = "average"
    z: tuple[int, int] | None = None
    y: tuple[int, int] | None = None
    x: tuple[int, int] | None = None
    clip_min: float | None = None
    clip_max: float | None = None
    mask_below: float | None = None
    uint8: bool = False

    def __post_init__(self):
        check_options(factor=self.factor)
        if self.mode not in ("average", "subsample"):
            raise ValueError("mode is average or subsample")
        if self.uint8 and (self.clip_min is None or self.clip_max is None or self.clip_min >= self.clip_max):
            raise ValueError("bytes need both clip bounds, the lower one first")


def reduce_volumes(voxels: DataFrame, options: Options) -> DataFrame:
    """(series, seq, z, y, x, v) of the reduced volumes; v is a float, or a short of 0..255."""
    start = {a: r[0] for a, r in (("z", options.z), ("y", options.y), ("x", options.x)) if r}
    rows = slices.crop(voxels, options.z, options.y, options.x)
    if options.mode == "average":
        rows = transform.block_mean(rows, options.factor, start=start)
    else:
        rows = transform.subsample(rows, options.factor, start)
    return rows.withColumn("v", _prepared(F.col("v"), options))


def output_type(source: str, options: Options) -> str:
    """The type that reduced volumes are stored in: bytes (as shorts) if asked for, else the source's own."""
    return "smallint" if options.uint8 else source


def stored(reduced: DataFrame, source: str, options: Options) -> DataFrame:
    """Reduced volumes in ``output_type``; means of integers lose their fraction, values beyond the type are an error."""
    return reduced.withColumn("v", F.col("v").cast(output_type(source, options)))


def _prepared(v: Column, options: Options) -> Column:
    v = scalars.clip_and_mask(v, options.clip_min, options.clip_max, options.mask_below)
    return scalars.to_uint8(v, options.clip_min, options.clip_max) if options.uint8 else v


def preview_views(voxels: DataFrame, options: Options, centre: tuple[int, int, int]) -> DataFrame:
    """(series, seq, plane, row, col, v): three views through a centre in output coordinates, from one scan.

    The source planes of the centre's block are averaged whatever the mode, so in subsample mode a view
    differs from the plane of reduce_volumes; rows and columns are then averaged or subsampled.
    """
    n = options.factor
    start = {a: (getattr(options, a) or (0, 0))[0] for a in "zyx"}
    at = {a: (F.col(a) - start[a]) for a in "zyx"}
    block = {a: F.floor(at[a] / n).cast("int") for a in "zyx"}
    views = []
    for plane, axis, row, col in (("xy", "z", "y", "x"), ("xz", "y", "z", "x"), ("yz", "x", "z", "y")):
        first = target_to_source(centre["zyx".index(axis)], start[axis], n)
        hit = (F.col(axis) >= first) & (F.col(axis) < first + n)
        if options.mode == "subsample":
            hit &= (at[row] % n == 0) & (at[col] % n == 0)
        views.append((hit, F.struct(F.lit(plane).alias("plane"), block[row].alias("row"), block[col].alias("col"))))
    rows = slices.crop(voxels, options.z, options.y, options.x).where(views[0][0] | views[1][0] | views[2][0])
    rows = rows.withColumn("p", F.explode(F.filter(F.array(*(F.when(*w) for w in views)), lambda p: p.isNotNull())))
    means = rows.groupBy("series", "seq", "p").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return means.select("series", "seq", "p.*", _prepared(F.col("v"), options).alias("v"))
