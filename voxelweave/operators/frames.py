"""Image frames of planes, as rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import normalised_frame


def display_range(planes: DataFrame, by: list[str], low: float | None = None, high: float | None = None, percentiles: tuple[float, float] = (0.01, 0.99)) -> DataFrame:
    """The fixed range if both bounds are given, else exact percentiles, where these are equal the least and greatest value.

    Values that are not finite count as 0.
    """
    if low is not None and high is not None:
        return planes.select(*by).distinct().withColumns({"low": F.lit(float(low)), "high": F.lit(float(high))})
    v = F.col("v").cast("double")
    v = F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), F.lit(0.0)).otherwise(v)
    p = planes.groupBy(*by).agg(F.percentile(v, F.array(*map(F.lit, percentiles))).alias("p"), F.min(v).alias("least"), F.max(v).alias("most"))
    flat = F.col("p")[0] == F.col("p")[1]
    return p.select(*by, *(F.when(flat, F.col(end)).otherwise(F.col("p")[i]).alias(n) for i, (n, end) in enumerate((("low", "least"), ("high", "most")))))


def normalised_frames(planes: DataFrame, by: list[str], **limits) -> DataFrame:
    """Planes (by, y, x, v) with v in 0..1; a plane of one value is black."""
    rows = planes.join(display_range(planes, by, **limits), by)
    return rows.select(*by, "y", "x", normalised_frame(F.col("v"), F.col("low"), F.col("high")).alias("v"))


#: Colour maps as places and levels of each channel, with straight lines between.
MAPS = {
    "gray": {"r": [(0.0, 0.0), (1.0, 1.0)], "g": [(0.0, 0.0), (1.0, 1.0)], "b": [(0.0, 0.0), (1.0, 1.0)]},
    "hot": {
        "r": [(0.0, 0.0416), (0.365079, 1.0), (1.0, 1.0)],
        "g": [(0.0, 0.0), (0.365079, 0.0), (0.746032, 1.0), (1.0, 1.0)],
        "b": [(0.0, 0.0), (0.746032, 0.0), (1.0, 1.0)],
    },
    "bone": {
        "r": [(0.0, 0.0), (0.746032, 0.652778), (1.0, 1.0)],
        "g": [(0.0, 0.0), (0.365079, 0.319444), (0.746032, 0.777778), (1.0, 1.0)],
        "b": [(0.0, 0.0), (0.365079, 0.444444), (1.0, 1.0)],
    },
    "cool": {"r": [(0.0, 0.0), (1.0, 1.0)], "g": [(0.0, 1.0), (1.0, 0.0)], "b": [(0.0, 1.0), (1.0, 1.0)]},
}
ENTRIES = 256


def colour_table(name: str) -> list[tuple[int, int, int, int]]:
    """(index, r, g, b) of a map's entries, from its lines; bytes are cut, not rounded."""
    if name not in MAPS:
        raise ValueError(f"no such colour map: {name}")
    places = np.linspace(0.0, 1.0, ENTRIES)
    levels = [np.interp(places, *zip(*MAPS[name][c], strict=True)) for c in "rgb"]
    return [(i, *(int(level[i] * 255.0) for level in levels)) for i in range(ENTRIES)]


def coloured(frames: DataFrame, by: list[str], name: str = "gray") -> DataFrame:
    """Normalised frames in a colour map: each value's entry, as r, g, b bytes."""
    table = frames.sparkSession.createDataFrame(colour_table(name), "i int, r smallint, g smallint, b smallint")
    rows = frames.select(*by, "y", "x", F.least(F.floor(F.col("v") * ENTRIES), F.lit(ENTRIES - 1)).cast("int").alias("i"))
    return rows.join(F.broadcast(table), "i").select(*by, "y", "x", F.struct("r", "g", "b").alias("rgb"))  # ENTRIES rows


def grey(frames: DataFrame, by: list[str]) -> DataFrame:
    """Normalised frames as r, g, b bytes of a grey map."""
    byte = F.floor(F.col("v") * 255).cast("smallint")
    return frames.select(*by, "y", "x", F.struct(byte.alias("r"), byte.alias("g"), byte.alias("b")).alias("rgb"))


def side_by_side(left: DataFrame, right: DataFrame, by: list[str], gap: int = 4, white: float = 1.0) -> DataFrame:
    """Two frames in one, gap white columns between them; the lower one is padded with zeros below."""
    def size(f: DataFrame, n: str) -> DataFrame:
        return f.groupBy(*by).agg((F.max("y") + 1).alias(f"h{n}"), (F.max("x") + 1).alias(f"w{n}"))

    sizes = size(left, "l").join(size(right, "r"), by)
    tall = F.greatest("hl", "hr")
    moved = right.join(sizes, by).select(*by, "y", (F.col("x") + F.col("wl") + gap).alias("x"), "v")
    bar = sizes.select(*by, F.explode(F.sequence(F.lit(0), tall - 1)).alias("y"), "wl").select(*by, "y", F.explode(F.sequence(F.col("wl"), F.col("wl") + gap - 1)).alias("x"), F.lit(white).alias("v"))

    def padding(h: str, w: str, at) -> DataFrame:
        rows = sizes.where(F.col(h) < tall).select(*by, F.explode(F.sequence(F.col(h), tall - 1)).alias("y"), at.alias("at"), w)
        return rows.select(*by, "y", F.explode(F.sequence(F.col("at"), F.col("at") + F.col(w) - 1)).alias("x"), F.lit(0.0).alias("v"))

    pads = padding("hl", "wl", F.lit(0)).union(padding("hr", "wr", F.col("wl") + gap))
    return left.select(*by, "y", "x", "v").union(moved).union(bar).union(pads)
