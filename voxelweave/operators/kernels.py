"""Reductions on the arrays of tiles: no voxel becomes a row before it has been reduced.

A tile is summed up over its part of the blocks where it lies, and only these sums travel; tiles of the
same place are then added element by element, and blocks that lie in several tiles at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import several_tiles

PLACE = ["series", "seq", "y0", "x0", "ny", "nx"]
#: Planes whose sums are added in one step.
PLANES = 32
_PARTIAL = "series string, seq int, z int, y0 int, x0 int, ny int, nx int, sums array<double>, counts array<bigint>"
Factors = tuple[int, int, int]


def _edges(first: int, n: int, factor: int) -> tuple[np.ndarray, int]:
    """Where the blocks of n cells from first on start, and the number of the first block."""
    block = (first + np.arange(n)) // factor
    return np.flatnonzero(np.concatenate(([True], np.diff(block) != 0))), int(block[0])


def _reduced(factors: Factors, start: Factors):
    """Sums and counts of each tile over its blocks; places are then counted in blocks."""
    _, fy, fx = factors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y0, x0, ny, nx = (batch.column(i).to_pylist() for i in range(3, 7))
            out: list[list] = [[] for _ in range(6)]
            for i in range(batch.num_rows):
                v = batch.column(7)[i].values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(ny[i], nx[i])
                (rows, top), (cols, left) = _edges(y0[i] - start[1], ny[i], fy), _edges(x0[i] - start[2], nx[i], fx)
                sums = np.add.reduceat(np.add.reduceat(v, rows, 0), cols, 1)
                counts = np.outer(np.diff(np.append(rows, ny[i])), np.diff(np.append(cols, nx[i])))
                for col, value in zip(out, (top, left, *sums.shape, sums.ravel(), counts.ravel()), strict=True):
                    col.append(value)
            arrays = [pa.array(c, pa.int32()) for c in out[:4]] + [pa.array(out[4], pa.list_(pa.float64())), pa.array(out[5], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *arrays], [c.split()[0] for c in _PARTIAL.split(", ")])

    return run


def _added(lists: Column) -> Column:
    """Element by element over a list of arrays of one length."""
    return F.aggregate(F.slice(lists, 2, F.greatest(F.size(lists) - 1, F.lit(0))), lists[0], lambda a, b: F.zip_with(a, b, lambda x, y: x + y))


def _by_place(parts: DataFrame, z: Column) -> DataFrame:
    """Parts of one place and z, added up; a group has at most as many as share that z."""
    lists = parts.groupBy(*PLACE, z.alias("z")).agg(F.collect_list("sums").alias("sums"), F.collect_list("counts").alias("counts"))
    return lists.withColumns({c: _added(F.col(c)) for c in ("sums", "counts")})


def _cells(rows: DataFrame, value: Column | str, i: str = "i") -> DataFrame:
    at = {"y": F.col("y0") + F.floor(F.col(i) / F.col("nx")), "x": F.col("x0") + F.col(i) % F.col("nx")}
    return rows.select("series", "seq", "z", *(v.cast("int").alias(c) for c, v in at.items()), value)


def block_means(tiles: DataFrame, factors: Factors, start: Factors = (0, 0, 0)) -> DataFrame:
    """(series, seq, z, y, x, v): means over blocks of factors (z, y, x), counted from start; blocks at an edge average what they have.

    Tiles lie at or beyond start (``volumes.crop_tiles`` cuts them).
    """
    parts = tiles.select("series", "seq", "z", "y0", "x0", "ny", "nx", "data").where("size(data) > 0").mapInArrow(_reduced(factors, start), _PARTIAL)
    parts, left = parts.withColumn("z", F.col("z") - start[0]), factors[0]
    while left > 1:  # at most PLANES are added at a time, however deep the blocks
        step = left if left <= PLANES else next(k for k in range(PLANES, 0, -1) if left % k == 0)
        if step == 1:
            step = left
        parts, left = _by_place(parts, F.floor(F.col("z") / step).cast("int")), left // step
    pairs = F.posexplode(F.arrays_zip("sums", "counts")).alias("i", "p")
    cells = _cells(parts.select(*PLACE, "z", pairs).select(*PLACE, "z", "i", "p.sums", "p.counts").withColumn("sc", F.struct("sums", "counts")), "sc")
    if several_tiles(tiles):
        cells = cells.groupBy("series", "seq", "z", "y", "x").agg(F.struct(F.sum("sc.sums").alias("sums"), F.sum("sc.counts").alias("counts")).alias("sc"))
    return cells.select("series", "seq", "z", "y", "x", (F.col("sc.sums") / F.col("sc.counts")).alias("v"))


def slab_means(tiles: DataFrame, axis: str, start: int, stop: int) -> DataFrame:
    """(series, seq, the two other axes, v): means along an axis within [start, stop)."""
    others = [a for a in ("z", "y", "x") if a != axis]
    n = stop - start
    if axis == "z":
        inside = tiles.where((F.col("z") >= start) & (F.col("z") < stop))
        parts = inside.select("series", "seq", "z", "y0", "x0", "ny", "nx", "data").where("size(data) > 0").mapInArrow(_reduced((1, 1, 1), (0, 0, 0)), _PARTIAL)
        parts, left = parts.withColumn("z", F.col("z") - start), n
        while left > 1:  # PLANES of them are added at a time, however deep the slab
            parts, left = _by_place(parts, F.floor(F.col("z") / PLANES).cast("int")), -(-left // PLANES)
        cells = parts.select(*PLACE, "z", F.posexplode(F.zip_with("sums", "counts", lambda s, c: s / c)).alias("i", "v"))
        return _cells(cells, "v").select("series", "seq", "y", "x", "v")
    from ..sources.volumes import crop_tiles

    bounds, factors = {axis: (start, stop)}, tuple(n if a == axis else 1 for a in ("z", "y", "x"))
    return block_means(crop_tiles(tiles, **bounds), factors).select("series", "seq", *others, "v")


def subsampled(tiles: DataFrame, factor: int, start: Factors = (0, 0, 0)) -> DataFrame:
    """(series, seq, z, y, x, v): the first voxel of each block; other planes are not read, other voxels never become rows."""
    z, y, x = start
    kept = tiles.where((F.col("z") - z) % factor == 0)
    row, col = F.col("y0") - y, F.col("x0") - x

    def first(place: Column) -> Column:
        """The next multiple of factor."""
        return (F.ceil(place / factor) * factor).cast("int")

    at = F.filter(F.transform("data", lambda v, i: F.struct((row + F.floor(i / F.col("nx"))).cast("int").alias("y"), (col + i % F.col("nx")).cast("int").alias("x"), v.alias("v"))), lambda c: (c["y"] % factor == 0) & (c["x"] % factor == 0))
    some = kept.where((first(row) < row + F.col("ny")) & (first(col) < col + F.col("nx"))).withColumn("c", F.explode(at))
    blocks = [F.floor(p / factor).cast("int").alias(n) for n, p in (("z", F.col("z") - z), ("y", F.col("c.y")), ("x", F.col("c.x")))]
    return some.select("series", "seq", *blocks, F.col("c.v").alias("v"))
