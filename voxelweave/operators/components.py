"""Connected regions of masked voxels within a slice."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import few, materialize
from . import graph

SLICE = ["series", "seq", "prev_seq", "z"]


def label_cells(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For each cell the index of the first cell, in raster order, that it reaches over the eight neighbours.

    Cells come in raster order. They are joined into horizontal runs first; runs of neighbouring
    rows that touch are then united.
    """
    n = len(y)
    if not n:
        return np.empty(0, np.int64)
    new = np.concatenate(([True], (y[1:] != y[:-1]) | (x[1:] != x[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [n])) - 1
    root = list(range(len(first)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    rows = y[first]
    above = 0
    for i in range(len(first)):
        while above < i and (rows[above] < rows[i] - 1 or rows[above] == rows[i] - 1 and x[last[above]] < x[first[i]] - 1):
            above += 1
        k = above
        while k < i and rows[k] == rows[i] - 1 and x[first[k]] <= x[last[i]] + 1:
            a, b = find(k), find(i)
            root[max(a, b)] = min(a, b)
            k += 1
    top = np.array([first[find(i)] for i in range(len(first))])
    return top[np.cumsum(new) - 1]


def labelled(masked: DataFrame) -> DataFrame:
    """The masked voxels with label, the raster position (y << 32 | x) of their region's first voxel.

    One group is one slice, so it is bounded by the slice's voxels.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["y", "x"], kind="stable")
        at = label_cells(pdf["y"].to_numpy(np.int64), pdf["x"].to_numpy(np.int64))
        raster = (pdf["y"].to_numpy(np.int64) << 32) | pdf["x"].to_numpy(np.int64)
        return pdf.assign(label=raster[at])

    cols = masked.select(*SLICE, "y", "x", "d")
    schema = "series string, seq int, prev_seq int, z int, y int, x int, d float, label bigint"
    return cols.groupBy(*SLICE).applyInPandas(run, schema)


def aggregated(cells: DataFrame, min_size: int = 16) -> DataFrame:
    """COMPONENT rows of each slice with at least min_size voxels; of equal peaks the first in raster order counts."""
    d = F.col("d").cast("double")
    out = cells.groupBy(*SLICE, "label").agg(
        *(f(c).alias(f"{c}_{n}") for c in ("y", "x") for n, f in (("min", F.min), ("max", F.max))),
        F.count(F.lit(1)).alias("voxel_count"),
        F.max(F.abs(d)).alias("peak_abs_diff"),
        F.max_by(d, F.struct(F.abs(d), -F.col("y"), -F.col("x"))).alias("peak_signed_diff"),
        F.sum(F.abs(d)).alias("sum_abs_diff"),
        F.sum(d).alias("sum_signed_diff"),
        *(F.sum(F.col(c).cast("double")).alias(f"{c}_weighted_sum") for c in ("y", "x")),
    )
    out = out.where(F.col("voxel_count") >= min_size)
    return out.withColumn("z_weighted_sum", F.col("z").cast("double") * F.col("voxel_count"))


_SLICE_TYPES = "series string, seq int, prev_seq int, z int"
_PART = (
    f"{_SLICE_TYPES}, label bigint, y_min int, y_max int, x_min int, x_max int, voxel_count bigint, peak_abs_diff double, peak_signed_diff double, "
    "peak_at bigint, sum_abs_diff double, sum_signed_diff double, y_weighted_sum double, x_weighted_sum double, edge array<bigint>"
)
_CELL = f"{_SLICE_TYPES}, y int, x int, d float, label bigint, on_edge boolean"


class _Masked:
    """The masked cells of a batch of tiles, labelled within their tiles, all tiles at once."""

    def __init__(self, batch: pa.RecordBatch):
        y0, x0, ny, nx = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4, 8))
        data, threshold = batch.column(8), batch.column(9).to_numpy(zero_copy_only=False).astype(np.float32)
        n = np.array(data.value_lengths().fill_null(0))
        d = data.flatten().to_numpy(zero_copy_only=False)
        tile = np.repeat(np.arange(batch.num_rows), n)
        with np.errstate(invalid="ignore"):
            at = np.flatnonzero(np.abs(d) >= threshold[tile])  # not a number is never masked
        place = at - (np.cumsum(n) - n)[tile[at]]
        self.tile, self.d = tile[at], d[at]
        row, col = np.divmod(place, np.maximum(nx, 1)[self.tile])
        # tiles one below the other, a blank line between them
        first = label_cells((np.cumsum(ny + 1) - ny)[self.tile] + row, col)
        self.y, self.x = y0[self.tile] + row, x0[self.tile] + col
        self.at = self.y << 32 | self.x
        self.label = self.at[first] if len(first) else self.at
        self.first = first
        self.on_edge = (row == 0) | (col == 0) | (row == ny[self.tile] - 1) | (col == nx[self.tile] - 1)


def _table(columns: list[pa.Array], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])


def _tile_columns(diffs: DataFrame) -> DataFrame:
    """diffs with threshold, as the functions below read them."""
    return diffs.select(*SLICE, "y0", "x0", "ny", "nx", "data", F.col("threshold").cast("float").alias("threshold"))


def _tile_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        m = _Masked(batch)
        if not len(m.d):
            continue
        d = m.d.astype(np.float64)
        size = np.abs(d)
        _, group = np.unique(m.first, return_inverse=True)
        k = int(group.max()) + 1
        by = np.lexsort((m.at, -size, group))  # the first of each group is its peak
        start = np.flatnonzero(np.concatenate(([True], np.diff(group[by]) != 0)))
        peak = by[start]
        ends = [f.reduceat(v[by], start) for v in (m.y, m.x) for f in (np.minimum, np.maximum)]
        sums = [np.bincount(group, v, k) for v in (size, d, m.y.astype(np.float64), m.x.astype(np.float64))]
        edge = np.flatnonzero(m.on_edge)
        edge = edge[np.argsort(group[edge], kind="stable")]
        lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(np.bincount(group[edge], minlength=k)))).astype(np.int32), pa.array(m.at[edge]))
        cols = [batch.column(i).take(pa.array(m.tile[peak])) for i in range(4)]
        cols += [pa.array(m.label[peak]), *(pa.array(e.astype(np.int32)) for e in ends), pa.array(np.bincount(group, minlength=k)), pa.array(size[peak]), pa.array(d[peak]), pa.array(m.at[peak]), *map(pa.array, sums), lists]
        yield _table(cols, _PART)


def _tile_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        m = _Masked(batch)
        cols = [batch.column(i).take(pa.array(m.tile)) for i in range(4)]
        cols += [pa.array(m.y.astype(np.int32)), pa.array(m.x.astype(np.int32)), pa.array(m.d, pa.float32()), pa.array(m.label), pa.array(m.on_edge)]
        yield _table(cols, _CELL)


def _roots(cells: DataFrame) -> DataFrame:
    """(SLICE, label, root) of the labels that meet others across edges of tiles. cells: masked edge cells (SLICE, label, at).

    Neighbouring cells of one tile have one label; so what joins two labels lies on edges of tiles.
    """
    here = cells.select(*SLICE, F.shiftright("at", 32).alias("y"), F.col("at").bitwiseAND(F.lit(2**32 - 1)).alias("x"), "label")
    ahead = F.array(*(F.struct((F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x")) for dy, dx in ((0, 1), (1, -1), (1, 0), (1, 1))))
    near = here.select(*SLICE, F.col("label").alias("b"), F.explode(ahead).alias("n")).select(*SLICE, "b", "n.y", "n.x")
    links = here.withColumnRenamed("label", "a").join(near, [*SLICE, "y", "x"]).where("a <> b").select(*SLICE, "a", "b")
    return graph.roots(links, SLICE).withColumnRenamed("id", "label")


def several_tiles(tiles: DataFrame) -> bool:
    """Whether planes are cut into tiles; reads two columns, up to the first tile that says so."""
    return not tiles.where("y0 > 0 or x0 > 0").limit(1).isEmpty()


def tile_labels(diffs: DataFrame) -> DataFrame:
    """``labelled`` for tiles with threshold: (SLICE, y, x, d, label) of the masked voxels.

    Each tile is labelled where it lies; labels that meet across edges of tiles are united by a graph over
    slices' edge cells alone, in joins. No task holds a whole plane.
    """
    cells = _tile_columns(diffs).mapInArrow(_tile_cells, _CELL)
    if not several_tiles(diffs):
        return cells.drop("on_edge")
    cells = materialize(cells, "cells")
    at = F.shiftleft(F.col("y").cast("bigint"), 32).bitwiseOR(F.col("x").cast("bigint"))
    roots = _roots(cells.where("on_edge").select(*SLICE, "label", at.alias("at")))
    joined = cells.drop("on_edge").join(few(roots), [*SLICE, "label"], "left")
    return joined.withColumn("label", F.coalesce("root", "label")).select(*SLICE, "y", "x", "d", "label")


def tile_regions(diffs: DataFrame, min_size: int = 16) -> DataFrame:
    """``aggregated`` for tiles with threshold. Cells never become rows: a tile's regions are summed up where it lies.

    Where planes are one tile each nothing is shuffled; else only regions are, and cells on edges of tiles.
    """
    parts = _tile_columns(diffs).mapInArrow(_tile_parts, _PART)
    if several_tiles(diffs):
        parts = materialize(parts, "tile-regions")
        roots = _roots(parts.select(*SLICE, "label", F.explode("edge").alias("at")))
        joined = parts.drop("edge").join(few(roots), [*SLICE, "label"], "left").withColumn("label", F.coalesce("root", "label"))
        ends = [f(f"{c}_{n}").alias(f"{c}_{n}") for c in ("y", "x") for n, f in (("min", F.min), ("max", F.max))]
        sums = [F.sum(c).alias(c) for c in ("sum_abs_diff", "sum_signed_diff", "y_weighted_sum", "x_weighted_sum")]
        strongest = F.max_by("peak_signed_diff", F.struct("peak_abs_diff", -F.col("peak_at"))).alias("peak_signed_diff")
        parts = joined.groupBy(*SLICE, "label").agg(*ends, F.sum("voxel_count").alias("voxel_count"), F.max("peak_abs_diff").alias("peak_abs_diff"), strongest, *sums)
    out = parts.drop("edge", "peak_at").where(F.col("voxel_count") >= min_size)
    return out.withColumn("z_weighted_sum", F.col("z").cast("double") * F.col("voxel_count"))


def touching(components: DataFrame, gap: int) -> DataFrame:
    """Pairs of regions in neighbouring slices whose boxes are within gap: an equi join on z with a range condition."""
    key = ["series", "seq", "prev_seq"]
    up = components.select(*key, F.col("z"), *(F.col(c).alias(c) for c in ("label", "y_min", "y_max", "x_min", "x_max")))
    low = components.select(*key, (F.col("z") + 1).alias("z"), *(F.col(c).alias(f"below_{c}") for c in ("label", "y_min", "y_max", "x_min", "x_max")))
    near = (F.col("below_y_min") <= F.col("y_max") + gap) & (F.col("y_min") <= F.col("below_y_max") + gap) & (F.col("below_x_min") <= F.col("x_max") + gap) & (F.col("x_min") <= F.col("below_x_max") + gap)
    return up.join(low, [*key, "z"]).where(near).select(*key, "z", "label", "below_label")
