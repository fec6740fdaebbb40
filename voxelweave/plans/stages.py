"""The stages of comparing one pair, each run on its own and measured.

Counts come from Spark's observed metrics, so each stage is one action of which no row leaves the executors.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import diff
from ..sources import volumes
from . import tracking

#: Planes on each side of the preview plane.
WINDOW = 2


@dataclass(frozen=True)
class Stage:
    """rows: voxels that the stage looked at; value: what it is after; seconds: how long it took."""

    name: str
    rows: int
    value: float | None
    seconds: float


class _Clock:
    def __init__(self) -> None:
        self.done: list[Stage] = []

    def stage(self, name: str, df: DataFrame, rows: Column, value: Column) -> float | None:
        start, seen = time.perf_counter(), Observation(name)
        df.observe(seen, rows.alias("rows"), value.alias("value")).write.format("noop").mode("overwrite").save()
        found = seen.get
        value_ = None if found["value"] is None else float(found["value"])
        self.done.append(Stage(name, int(found["rows"] or 0), value_, time.perf_counter() - start))
        return value_


def of_pair(tiles: DataFrame, series: str, seq: int, prev_seq: int, options: tracking.Options = tracking.Options(), crop: tracking.Crop = tracking.Crop()) -> list[Stage]:
    """Shape, the middle planes of both, differences of the three planes around, noise, preview plane, and voxels beyond the threshold near it."""
    clock, voxels = _Clock(), F.sum(F.size("data"))
    both = tiles.where((F.col("series") == series) & F.col("seq").isin(seq, prev_seq))
    both = volumes.crop_tiles(both, crop.z, crop.y, crop.x)
    depth = clock.stage("shape", both.select("z", "ny", "nx"), F.sum(F.col("ny") * F.col("nx")), F.max("z") + 1)
    if depth is None:
        raise ValueError(f"no tiles of {series} #{seq:04d} and #{prev_seq:04d}")
    middle = int(depth) // 2
    clock.stage("slice_pair", both.where(F.col("z") == middle), voxels, F.sum(F.size("data") * 4))
    diffs = diff.tile_diffs(both)
    peak = F.max(F.array_max(F.transform("data", F.abs)))
    for z in (max(0, middle - 1), middle, min(int(depth) - 1, middle + 1)):
        clock.stage(f"diff_slice_{z}", diffs.where(F.col("z") == z), voxels, peak)
    limits = tracking.thresholds(diffs, options)
    threshold = clock.stage("noise", limits, F.count(F.lit(1)), F.max("threshold"))
    best = clock.stage("preview_slice", diff.preview_slice(diffs), F.count(F.lit(1)), F.max("z"))
    if threshold is not None and best is not None:
        near = diff.masked(diffs.where((F.col("z") >= int(best) - WINDOW) & (F.col("z") <= int(best) + WINDOW)), F.lit(threshold))
        clock.stage("window", near, F.count(F.lit(1)), F.max(F.abs("d")))
    return clock.done
