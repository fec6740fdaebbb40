"""Differences of volumes with their predecessors, noise and thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ranges
from ..sources.volumes import coordinates
from ..storage import few, materialize

#: Fixed value: the 0.75 quantile of the standard normal distribution.
NORMAL_QUARTILE = 0.6744897501960817
#: Fixed value: voxels that noise and statistics are taken from, about.
SAMPLES = 1_000_000


def tile_diffs(tiles: DataFrame) -> DataFrame:
    """Each tile minus the same tile of the member before: one window, no join, arithmetic in float.

    Filter tiles to the admitted members first; every member needs the same tiles (``mismatched``).
    """
    order = Window.partitionBy("series", "z", "y0", "x0").orderBy("seq")
    # one lag for each column, so that plans which need no data move none
    before = {"prev_seq": "seq", "_data": "data", "_ny": "ny", "_nx": "nx"}
    rows = tiles.withColumns({c: F.lag(of).over(order) for c, of in before.items()}).where("prev_seq is not null")
    same = (F.col("_ny") == F.col("ny")) & (F.col("_nx") == F.col("nx"))
    data = F.zip_with("data", "_data", lambda a, b: (a - b).cast("float"))
    checked = F.when(F.col("_ny").isNull() | same, data).otherwise(F.raise_error(F.lit("volumes differ in shape")).cast("array<float>"))
    return rows.select("series", "seq", "prev_seq", "z", "y0", "x0", "ny", "nx", checked.alias("data"))


def mismatched(shapes: DataFrame) -> DataFrame:
    """Members whose shape differs from the member before."""
    order = Window.partitionBy("series").orderBy("seq")
    shape = F.struct("nz", "ny", "nx")
    return shapes.withColumn("before", F.lag(shape).over(order)).where((F.col("before").isNotNull()) & (shape != F.col("before")))


def voxel_diffs(diffs: DataFrame) -> DataFrame:
    """(series, seq, prev_seq, z, y, x, d)."""
    y, x = coordinates(F.col("i"))
    return diffs.select("*", F.posexplode("data").alias("i", "d")).select("series", "seq", "prev_seq", "z", y.alias("y"), x.alias("x"), "d")


def masked(diffs: DataFrame, threshold: Column) -> DataFrame:
    """Voxels with abs(d) >= threshold, compared in float; NaN never passes. Only these become rows."""
    t = threshold.cast("float")
    cells = F.transform("data", lambda d, i: F.struct(i.alias("i"), d.alias("d")))
    cells = F.filter(cells, lambda c: ~F.isnan(c["d"]) & (F.abs(c["d"]) >= t))
    y, x = coordinates(F.col("c.i"))
    return diffs.withColumn("c", F.explode(cells)).select("series", "seq", "prev_seq", "z", y.alias("y"), x.alias("x"), F.col("c.d").alias("d"))


def slice_maxima(diffs: DataFrame) -> DataFrame:
    """Largest abs(d) of each slice; a slice with NaN has none."""
    top = F.array_max(F.transform("data", F.abs))
    nan = F.exists("data", F.isnan)
    out = diffs.groupBy("series", "seq", "prev_seq", "z").agg(F.max(top).alias("m"), F.max(nan).alias("nan"))
    return out.select("series", "seq", "prev_seq", "z", F.when(~F.col("nan"), F.col("m").cast("double")).alias("max_abs_diff"))


def pair_maxima(diffs: DataFrame) -> DataFrame:
    """Largest abs(d) of each pair over slices without NaN, 0 if none."""
    return slice_maxima(diffs).groupBy("series", "seq", "prev_seq").agg(F.greatest(F.coalesce(F.max("max_abs_diff"), F.lit(0.0)), F.lit(0.0)).alias("max_abs_diff"))


def robust_sigma(values: DataFrame, by: list[str], value: str = "d") -> DataFrame:
    """Median absolute deviation over the normal quartile, or the standard deviation where that is 0."""
    v = values.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*by, F.col(value).cast("double").alias("v"))
    middle = v.groupBy(*by).agg(F.median("v").alias("m"), F.stddev_pop("v").alias("sd"))
    away = v.join(middle, by).groupBy(*by).agg(F.median(F.abs(F.col("v") - F.col("m"))).alias("mad"), F.first("sd").alias("sd"))
    return away.select(*by, F.when(F.col("mad") > 0, F.col("mad") / NORMAL_QUARTILE).otherwise(F.col("sd")).alias("sigma"))


def baseline_sigma(
    diffs: DataFrame, step: int | None = None, target: int = SAMPLES, start: tuple[int, int, int] = (0, 0, 0)
) -> DataFrame:
    """(series, sigma) of the first pair of each series, from every step-th voxel on each axis, counted from start.

    Without a step, it is the one that leaves about target voxels, from the size of that pair; so the
    exact medians see a bounded sample, however large the volumes are. A sample with a value that is no number has
    no noise to measure (null).
    """
    pairs = diffs.groupBy("series", "seq").agg(F.sum(F.col("ny") * F.col("nx")).alias("voxels"))
    by = ranges.stride(F.min_by("voxels", "seq"), target) if step is None else F.lit(step)
    first = pairs.groupBy("series").agg(F.min("seq").alias("seq"), by.alias("step"))
    every = {a: (F.col(a) - s) % F.col("step") == 0 for a, s in zip(("z", "y", "x"), start, strict=True)}
    tiles = diffs.join(few(first), ["series", "seq"]).where(every["z"])
    y, x = coordinates(F.col("i"))
    rows = tiles.select("*", F.posexplode("data").alias("i", "d")).select("series", "step", y.alias("y"), x.alias("x"), "d")
    sample = materialize(rows.where(every["y"] & every["x"]).select("series", "d"), "noise")  # about target rows a series
    broken = sample.groupBy("series").agg(F.max(F.isnan("d")).alias("broken"))
    return robust_sigma(sample, ["series"]).join(broken, "series").select("series", F.when(~F.col("broken"), F.col("sigma")).alias("sigma"))


def preview_slice(diffs: DataFrame, planes: int = 32, lines: int = 512, shape: tuple[int, int, int] | None = None) -> DataFrame:
    """Per pair the z of the largest abs(d), the first of equal ones, over about planes planes and lines lines of each.

    Strides come from the declared shape, else from the planes and lines that the pair has; the last plane is looked at, too.
    """
    pair = ["series", "seq", "prev_seq"]
    if shape is None:
        found = diffs.groupBy(*pair).agg((F.max("z") + 1).alias("_nz"), F.max(F.col("y0") + F.col("ny")).alias("_ny"), F.max(F.col("x0") + F.col("nx")).alias("_nx"))
        steps = found.select(*pair, (F.col("_nz") - 1).alias("_end"), F.greatest(F.floor(F.col("_nz") / planes), F.lit(1)).alias("_dz"), F.greatest(F.floor(F.least("_ny", "_nx") / lines), F.lit(1)).alias("_d"))
        some = diffs.join(few(steps), pair)
    else:
        nz, ny, nx = shape
        some = diffs.withColumns({"_end": F.lit(nz - 1), "_dz": F.lit(max(nz // planes, 1)), "_d": F.lit(max(min(ny, nx) // lines, 1))})
    some = some.where((F.col("z") % F.col("_dz") == 0) | (F.col("z") == F.col("_end")))

    def on_grid(v: Column, i: Column) -> Column:
        y, x = coordinates(i)
        return (y % F.col("_d") == 0) & (x % F.col("_d") == 0)

    seen = F.when(F.col("_d") == 1, F.col("data")).otherwise(F.filter("data", on_grid))
    top = slice_maxima(some.withColumn("data", seen).where("size(data) > 0")).where("max_abs_diff is not null")
    return top.groupBy(*pair).agg(F.max_by("z", F.struct("max_abs_diff", -F.col("z"))).alias("z"), F.max("max_abs_diff").alias("max_abs_diff"))


def against_reference(tiles: DataFrame, reference_seq: int) -> DataFrame:
    """All members minus one reference member, joined by tile."""
    key = ["series", "z", "y0", "x0"]
    ref = tiles.where(F.col("seq") == reference_seq).select(*key, F.col("data").alias("ref"))
    rows = tiles.where(F.col("seq") != reference_seq).join(ref, key)
    data = F.zip_with("data", "ref", lambda a, b: (a - b).cast("float"))
    return rows.select("series", "seq", F.lit(reference_seq).alias("prev_seq"), "z", "y0", "x0", "ny", "nx", data.alias("data"))


def aligned_planes(a: DataFrame, b: DataFrame) -> DataFrame:
    """a - b of two planes (key, y, x, v) after cutting both to their common size around the centre."""

    def sized(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg((F.max("y") + 1).alias("ny"), (F.max("x") + 1).alias("nx"))

    sizes = sized(a).join(sized(b).withColumnsRenamed({"ny": "my", "nx": "mx"}), "key")

    def shifted(rows: DataFrame, ny: str, nx: str) -> DataFrame:
        cut = rows.join(sizes, "key").withColumns({"oy": F.floor((F.col(ny) - F.least("ny", "my")) / 2), "ox": F.floor((F.col(nx) - F.least("nx", "mx")) / 2)})
        moved = cut.withColumns({"y": (F.col("y") - F.col("oy")).cast("int"), "x": (F.col("x") - F.col("ox")).cast("int")})
        return moved.where((F.col("y") >= 0) & (F.col("y") < F.least("ny", "my")) & (F.col("x") >= 0) & (F.col("x") < F.least("nx", "mx"))).select("key", "y", "x", "v")

    both = shifted(a, "ny", "nx").join(shifted(b, "my", "mx").withColumnRenamed("v", "w"), ["key", "y", "x"])
    return both.select("key", "y", "x", (F.col("v") - F.col("w")).cast("float").alias("d"))
