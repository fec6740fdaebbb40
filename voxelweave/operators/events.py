"""Three-dimensional events from the regions of successive slices, and their tables."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema

PAIR = ["series", "seq", "prev_seq"]
_SUMS = ["sum_abs_diff", "sum_signed_diff", "z_weighted_sum", "y_weighted_sum", "x_weighted_sum"]


@dataclass
class _Event:
    """What the fold carries of an open event: its box over all slices so far, and its totals."""

    number: int
    last_z: int
    box: list[int] = field(default_factory=list)  # z, y, x minima, then maxima
    voxels: int = 0
    peak: tuple[float, float] = (-1.0, 0.0)
    sums: list[float] = field(default_factory=lambda: [0.0] * len(_SUMS))

    def near(self, box: list[int], gap: int) -> bool:
        return all(self.box[k] <= box[k + 3] + gap and box[k] <= self.box[k + 3] + gap for k in (1, 2))

    def add(self, box: list[int], voxels: int, peak: tuple[float, float], sums: list[float]) -> None:
        self.box = box if not self.box else [*map(min, self.box[:3], box[:3]), *map(max, self.box[3:], box[3:])]
        self.voxels += voxels
        self.peak = peak if peak[0] > self.peak[0] else self.peak
        self.sums = [a + b for a, b in zip(self.sums, sums, strict=True)]


def fold(components: pd.DataFrame, gap: int) -> list[_Event]:
    """Events in the order in which they end."""
    return _folded(components, gap)[0]


def _folded(components: pd.DataFrame, gap: int) -> tuple[list[_Event], int]:
    """Events in the order in which they end, and how many were started (some have been joined into others).

    Slices come in ascending order, regions in raster order. A region continues the open events
    that the slice before extended and whose whole box so far is within gap; it joins them into the
    oldest. An event extended in this slice takes no second region of it, so a split starts anew.
    """
    ordered = components.sort_values(["z", "label"], kind="stable")
    active: list[_Event] = []
    done: list[_Event] = []
    count = 0
    for z, rows in ordered.groupby("z", sort=True):
        done += [e for e in active if e.last_z < z - 1]
        active = [e for e in active if e.last_z >= z - 1]
        for r in rows.itertuples(index=False):
            box = [r.z, r.y_min, r.x_min, r.z, r.y_max, r.x_max]
            hit = [e for e in active if e.last_z == z - 1 and e.near(box, gap)]
            if hit:
                event = hit[0]
                for other in hit[1:]:
                    event.add(other.box, other.voxels, other.peak, other.sums)
                    active.remove(other)
            else:
                count += 1
                event = _Event(count, z)
                active.append(event)
            event.add(box, r.voxel_count, (r.peak_abs_diff, r.peak_signed_diff), [getattr(r, s) for s in _SUMS])
            event.last_z = z
        done += [e for e in active if e.last_z < z]
        active = [e for e in active if e.last_z == z]
    return done + active, count


def islands(components: DataFrame) -> DataFrame:
    """components with island: slices of a pair up to the next one without regions, where every event ends."""
    order = Window.partitionBy(*PAIR).orderBy("z", "label")
    new = (F.col("z") - F.lag("z").over(order) > 1).cast("int")
    rows = components.withColumn("new", F.coalesce(new, F.lit(0)))
    return rows.withColumn("island", F.sum("new").over(order).cast("int")).drop("new")


def assemble(components: DataFrame, min_size: int = 1000, gap: int = 10) -> DataFrame:
    """EVENT rows of each pair with at least min_size voxels.

    A group is an island of slices, not a pair: events neither cross an empty slice nor end after one. Each
    island numbers its own events; those of the islands before are added by a running sum.
    """
    names = [c.split()[0] for c in schema.EVENT.split(", ")]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found, started = _folded(pdf, gap)
        rows = [(*key, 0, 0, e.number, i, e.box[0], e.box[3], e.box[1], e.box[4], e.box[2], e.box[5], e.voxels, *e.peak, *e.sums) for i, e in enumerate(found) if e.voxels >= min_size]
        rows.append((*key, started, len(found), *(None for _ in names)))
        return pd.DataFrame(rows, columns=[*PAIR, "island", "started", "ended", *names]).astype({n: "Int64" for n in names[:9]})

    out = islands(components).groupBy(*PAIR, "island").applyInPandas(run, f"series string, seq int, prev_seq int, island int, started int, ended int, {schema.EVENT}")
    before = Window.partitionBy(*PAIR).orderBy("island").rangeBetween(Window.unboundedPreceding, -1)
    counted = {"event_id": "started", "finish_order": "ended"}
    out = out.withColumns({n: F.coalesce(F.sum(n).over(before), F.lit(0)).cast("int") for n in counted.values()}).where("event_id is not null")
    return out.withColumns({c: F.col(c) + F.col(n) for c, n in counted.items()}).drop("island", *counted.values())


def ranked(events: DataFrame, max_events: int = 100) -> DataFrame:
    """The max_events strongest events of each pair, with their rank; of equal peaks the one that ended first."""
    rank = F.row_number().over(Window.partitionBy(*PAIR).orderBy(F.desc("peak_abs_diff"), "finish_order"))
    return events.withColumn("event_rank", rank).where(F.col("event_rank") <= max_events)


def described(events: DataFrame, crop_start: tuple[int, int, int] = (0, 0, 0)) -> DataFrame:
    """With means, centroids and the coordinates in the uncropped volume."""
    n = F.greatest(F.col("voxel_count"), F.lit(1))
    out = events.withColumns({"mean_abs_diff": F.col("sum_abs_diff") / n, "mean_signed_diff": F.col("sum_signed_diff") / n, **{f"{a}_centroid": F.col(f"{a}_weighted_sum") / n for a in "zyx"}})
    return out.withColumns({f"full_{a}_{c}": F.col(f"{a}_{c}") + s for a, s in zip("zyx", crop_start, strict=True) for c in ("centroid", "min", "max")})


def visible(events: DataFrame, z: int) -> DataFrame:
    return events.where((F.col("z_min") <= z) & (F.col("z_max") >= z))


def comparison_rows(pairs: DataFrame, maxima: DataFrame, events: DataFrame, max_events: int = 100) -> DataFrame:
    """A row per pair: events found and stored, and the largest difference; pairs without events too."""
    counts = events.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"))
    rows = pairs.join(maxima, PAIR, "left").join(counts, PAIR, "left")
    found = F.coalesce("n", F.lit(0)).cast("bigint")
    return rows.select(*PAIR, found.alias("detected_event_count"), F.least(found, F.lit(max_events).cast("bigint")).alias("stored_event_count"), F.coalesce("max_abs_diff", F.lit(0.0)).alias("max_abs_diff"))


def export_rows(comparisons: DataFrame, events: DataFrame) -> DataFrame:
    """Events with their comparison, ordered for the CSV file; comparisons without events have no row."""
    return comparisons.join(events, PAIR).orderBy("series", "seq", "event_rank")
