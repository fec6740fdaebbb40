"""Block means, subsampling and statistics of voxel rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ranges, scalars
from ..storage import few
from .diff import SAMPLES, robust_sigma

VOLUME = ["series", "seq"]
#: The percentiles of the statistics.
PERCENTILES = [0.1, 0.5, 1, 5, 50, 95, 99, 99.5, 99.9]


def _block(axis: str, factor: int, start: int = 0) -> Column:
    return F.floor((F.col(axis) - start) / factor).cast("int").alias(axis)


def block_mean(voxels: DataFrame, factor: int, axes: tuple[str, ...] = ("z", "y", "x"), start: dict[str, int] | None = None) -> DataFrame:
    """Mean over boxes of factor along the axes; boxes at the edge average what they have."""
    start = start or {}
    keys = [_block(a, factor, start.get(a, 0)) if a in axes else F.col(a) for a in ("z", "y", "x")]
    return voxels.groupBy(*VOLUME, *keys).agg(F.avg(F.col("v").cast("double")).alias("v"))


def subsample(voxels: DataFrame, factor: int, start: dict[str, int] | None = None) -> DataFrame:
    """The first voxel of each box."""
    start = start or {}
    for a in ("z", "y", "x"):
        voxels = voxels.where((F.col(a) - start.get(a, 0)) % factor == 0)
    return voxels.select(*VOLUME, *(_block(a, factor, start.get(a, 0)) for a in ("z", "y", "x")), "v")


def slab_mean(voxels: DataFrame, axis: str, start: int, stop: int) -> DataFrame:
    """Mean along one axis within [start, stop), by the two others."""
    others = [a for a in ("z", "y", "x") if a != axis]
    slab = voxels.where((F.col(axis) >= start) & (F.col(axis) < stop))
    return slab.groupBy(*VOLUME, *others).agg(F.avg(F.col("v").cast("double")).alias("v"))


def statistics(
    voxels: DataFrame, step: int | None = None, target: int = SAMPLES, start: dict[str, int] | None = None, factor: int = 1
) -> DataFrame:
    """Count, range, exact percentiles and robust sigma of every step-th voxel of each volume, counted from start.

    Without a step, it is the one that would leave about target voxels of the volume reduced by factor, times that
    factor: samples are voxels of the source.
    """
    by = F.lit(step)
    if step is None:
        extents = [F.ceil((F.max(a) - (start or {}).get(a, 0) + 1) / factor).cast("bigint") for a in ("z", "y", "x")]
        reduced = ranges.stride(extents[0] * extents[1] * extents[2], target) * factor
        sizes = voxels.groupBy(*VOLUME).agg(reduced.alias("step"))
        voxels, by = voxels.join(few(sizes), VOLUME), F.col("step")
    for a in ("z", "y", "x"):
        voxels = voxels.where((F.col(a) - (start or {}).get(a, 0)) % by == 0)
    some = voxels.where(~F.isnan("v")).withColumn("v", F.col("v").cast("double"))
    found = some.groupBy(*VOLUME).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.percentile("v", F.array(*(F.lit(p / 100) for p in PERCENTILES))).alias("p"))
    named = [F.col("p")[i].alias("p" + f"{p:g}".replace(".", "_")) for i, p in enumerate(PERCENTILES)]
    return found.select(*VOLUME, "n", "low", "high", *named).join(robust_sigma(some, VOLUME, "v"), VOLUME)


def suggestions(stats: DataFrame, shapes: DataFrame, factor: int = 1, item_bytes: int = 4, most: int = 1024**3) -> DataFrame:
    """Clip bounds at the half percentiles, a mask of three sigma, the factor that brings the output under most voxels, and sizes.

    shapes: ``volumes.shapes`` or ``volumes.declared`` of the source, which factor reduces. A suggested factor is two at least and never below the present one.
    """
    out = scalars.output_shape(F.array("nz", "ny", "nx"), factor)
    n = scalars.size_bytes(F.col("out"), 1)
    wanted = F.ceil(F.pow(n / F.lit(float(most)), F.lit(1 / 3))).cast("int")
    sizes = {"size": scalars.size_bytes(F.col("out"), item_bytes), "uint8_size": n, **{f"size_by_{k}": scalars.size_bytes(scalars.output_shape(F.col("out"), k), item_bytes) for k in (2, 4)}}
    rows = stats.join(shapes.select(*VOLUME, out.alias("out")), VOLUME)
    return rows.select(
        *VOLUME, F.col("p0_5").alias("clip_min"), F.col("p99_5").alias("clip_max"), F.greatest(3 * F.col("sigma"), F.lit(0.0)).alias("mask_below"),
        F.when(n <= most, F.lit(factor)).otherwise(F.greatest(wanted, F.lit(2), F.lit(factor))).alias("downsample"),
        *(scalars.readable_bytes(v).alias(c) for c, v in sizes.items()),
    )


def chunk_shape(shape: Column, z: int | None = None, y: int | None = None, x: int | None = None) -> Column:
    """8 x 256 x 256 within the shape; if any extent is given, a missing z is the full depth."""
    some = any(v is not None for v in (z, y, x))
    want = [shape[0] if some and z is None else F.lit(z or 8), F.lit(y or 256), F.lit(x or 256)]
    return F.array(*(F.least(shape[i], w) for i, w in enumerate(want)))
