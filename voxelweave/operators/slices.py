"""Crops, planes and strided reads of voxel rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Range = tuple[int, int]


def crop(rows: DataFrame, z: Range | None = None, y: Range | None = None, x: Range | None = None) -> DataFrame:
    """Voxels (or tiles, by z) within [start, stop) of each axis."""
    for axis, bounds in (("z", z), ("y", y), ("x", x)):
        if bounds:
            rows = rows.where((F.col(axis) >= bounds[0]) & (F.col(axis) < bounds[1]))
    return rows


def plane(voxels: DataFrame, axis: str, index: int) -> DataFrame:
    """A slice, by the two other axes."""
    return voxels.where(F.col(axis) == index).drop(axis)


def strided(rows: DataFrame, step: int, axes: tuple[str, ...] = ("y", "x"), start: dict[str, int] | None = None) -> DataFrame:
    """Every step-th voxel from the crop's start, coordinates counted in steps."""
    start = start or {}
    for a in axes:
        at = F.col(a) - start.get(a, 0)
        rows = rows.where(at % step == 0).withColumn(a, F.floor((F.col(a) - start.get(a, 0)) / step).cast("int"))
    return rows


def orthogonal(voxels: DataFrame, centre: tuple[int, int, int], fast: bool = False) -> DataFrame:
    """The xy, xz and yz planes through a centre in one scan: (plane, row, col, v). fast leaves out yz."""
    z, y, x = centre
    at = [(F.col("z") == z, "xy", "y", "x"), (F.col("y") == y, "xz", "z", "x")] + ([] if fast else [(F.col("x") == x, "yz", "z", "y")])
    on = at[0][0]
    for p in at[1:]:
        on |= p[0]
    planes = F.array(*(F.when(hit, F.struct(F.lit(name).alias("plane"), F.col(r).alias("row"), F.col(c).alias("col"))) for hit, name, r, c in at))
    rows = voxels.where(on).withColumn("p", F.explode(F.filter(planes, lambda p: p.isNotNull())))
    return rows.select("series", "seq", "p.*", "v")


def cut_planes(tiles: DataFrame, centre: tuple[int, int, int], fast: bool = False) -> DataFrame:
    """(series, seq, plane, row, col, width, data): ``orthogonal`` on the arrays of tiles.

    Each row is the rectangle that a plane has in common with a tile, its values line by line; no voxel beside
    the planes leaves its array.
    """
    z, y, x = centre

    def part(name: str, row: Column, col: Column, width: Column, data: Column) -> Column:
        return F.struct(F.lit(name).alias("plane"), row.cast("int").alias("row"), col.cast("int").alias("col"), width.cast("int").alias("width"), data.alias("data"))

    line = F.slice("data", (F.greatest(F.lit(y) - F.col("y0"), F.lit(0)) * F.col("nx") + 1).cast("int"), F.col("nx"))
    column = F.transform(F.sequence(F.lit(0), F.greatest(F.col("ny"), F.lit(1)) - 1), lambda i: F.try_element_at("data", (i * F.col("nx") + F.greatest(F.lit(x) - F.col("x0"), F.lit(0)) + 1).cast("int")))
    within = [(F.col(a) <= at) & (F.lit(at) < F.col(a) + F.col(n)) for a, n, at in (("y0", "ny", y), ("x0", "nx", x))]
    parts = [
        (F.col("z") == z, part("xy", F.col("y0"), F.col("x0"), F.col("nx"), F.col("data"))),
        (within[0], part("xz", F.col("z"), F.col("x0"), F.col("nx"), line)),
        (within[1], part("yz", F.col("z"), F.col("y0"), F.col("ny"), column)),
    ]
    parts = parts[:2] if fast else parts
    on = parts[0][0]
    for hit, _ in parts[1:]:
        on |= hit
    found = F.filter(F.array(*(F.when(*p) for p in parts)), lambda p: p.isNotNull())
    return tiles.where(on).select("series", "seq", F.explode(found).alias("p")).select("series", "seq", "p.*")


def pixels(planes: DataFrame, *columns: str) -> DataFrame:
    """Rows of ``cut_planes`` as (series, seq, plane, y, x, and a value of each of the array columns)."""
    values = F.posexplode(F.arrays_zip(*columns)).alias("i", "p")
    rows = planes.select("series", "seq", "plane", "row", "col", "width", values)
    at = {"y": F.col("row") + F.floor(F.col("i") / F.col("width")), "x": F.col("col") + F.col("i") % F.col("width")}
    return rows.select("series", "seq", "plane", *(v.cast("int").alias(n) for n, v in at.items()), *(f"p.{c}" for c in columns))
