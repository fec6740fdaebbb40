"""Expressions on voxel values, sizes and motor positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def deadband(d: Column, floor: float) -> Column:
    """Values within floor of zero become 0, others move towards it by floor."""
    return d if floor <= 0 else F.signum(d) * F.greatest(F.abs(d) - floor, F.lit(0.0))


def clip_and_mask(v: Column, low: float | None = None, high: float | None = None, mask_below: float | None = None) -> Column:
    v = v.cast("float")
    if low is not None:
        v = F.greatest(v, F.lit(low).cast("float"))
    if high is not None:
        v = F.least(v, F.lit(high).cast("float"))
    return v if mask_below is None else F.when(F.abs(v) < F.lit(mask_below).cast("float"), F.lit(0.0).cast("float")).otherwise(v)


def to_uint8(v: Column, low: float, high: float) -> Column:
    """0..255 over [low, high], truncated; apply after clip_and_mask, so that masked zeros are scaled too."""
    share = (v.cast("double") - low) / (high - low)
    return F.floor(F.greatest(F.lit(0.0), F.least(share, F.lit(1.0))) * 255).cast("smallint")


def normalised(v: Column, low: Column, high: Column) -> Column:
    """Into 0..1; values that are not finite are 0, a constant range is widened by a half to each side."""
    finite = F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), F.lit(0.0)).otherwise(v.cast("double"))
    flat = high <= low
    a, b = F.when(flat, low - 0.5).otherwise(low), F.when(flat, low + 0.5).otherwise(high)
    return F.greatest(F.lit(0.0), F.least((finite - a) / (b - a), F.lit(1.0)))


def normalised_frame(v: Column, low: Column, high: Column) -> Column:
    """Like ``normalised`` for saved frames: a constant range is black."""
    return F.when(high == low, F.lit(0.0)).otherwise(normalised(v, low, high))


def output_shape(shape: Column, factor: int) -> Column:
    return F.transform(shape, lambda n: F.ceil(n / factor).cast("int"))


def size_bytes(shape: Column, item_bytes: int) -> Column:
    return F.aggregate(shape, F.lit(1).cast("bigint"), lambda a, n: a * n) * item_bytes


def rounded(v: Column, digits: int) -> Column:
    """To so many digits by whole multiples, halves away from zero; ``round`` goes by the decimal text of v instead."""
    return F.round(v * 10.0**digits) / 10.0**digits


def readable_bytes(n: Column) -> Column:
    """One decimal and a unit from B to TB, each 1024 of the one before."""
    out = F.format_string("%.1f TB", F.bround(n / 2.0**40, 1))
    for power, unit in ((40, "GB"), (30, "MB"), (20, "KB"), (10, "B")):
        out = F.when(n < 2**power, F.format_string(f"%.1f {unit}", F.bround(n / 2.0 ** (power - 10), 1))).otherwise(out)
    return out


def progress_bar(done: Column, total: Column, width: int = 30) -> Column:
    filled = F.floor(width * F.least(done / F.greatest(total, F.lit(1)), F.lit(1.0))).cast("int")
    return F.concat(F.lit("["), F.repeat(F.lit("#"), filled), F.repeat(F.lit("-"), width - filled), F.lit("]"))


def pixel_to_mm(pixel: Column, size: Column, pixel_um: float, sign: int = 1) -> Column:
    return sign * (pixel - size / 2) * pixel_um / 1000


def half_acquisition_mm(pixels: Column, pixel_um: float, share: float = 0.8) -> Column:
    return pixels / 2 * share * pixel_um / 1000


def full_turn(angle: Column) -> Column:
    """The angle in [0, 360)."""
    return F.pmod(angle, F.lit(360.0))


def overlaid(base: Column, over: Column) -> Column:
    """A map with the entries of over in place of its own."""
    kept = F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(over), k))
    return F.map_concat(kept, over)
