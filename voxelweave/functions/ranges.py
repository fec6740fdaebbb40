"""Parsing of ranges, index lists and centres, for columns of user input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLANES = ("xy", "xz", "yz")


def _bound(part: Column, size: Column, default: Column) -> Column:
    n = F.trim(part).try_cast("int")
    wrapped = F.when(n < 0, n + size).otherwise(n)
    return F.when(F.trim(part) == "", default).when(n.isNotNull(), F.least(F.greatest(wrapped, F.lit(0)), size))


def crop_range(raw: Column, size: Column) -> Column:
    """struct(start, stop) of ``start:stop``; null is everything, an empty or malformed range is an error."""
    parts = F.split(raw, ":")
    start, stop = _bound(parts[0], size, F.lit(0)), _bound(F.try_element_at(parts, F.lit(2)), size, size)
    fine = (F.size(parts) == 2) & (start < stop)
    found = F.when(fine, F.struct(start.alias("start"), stop.alias("stop")))
    wrong = F.raise_error(F.concat(F.lit("bad crop range "), raw))
    whole = F.struct(F.lit(0).alias("start"), size.alias("stop"))
    return F.when(raw.isNull(), whole).when(fine, found).otherwise(wrong.cast("struct<start:int,stop:int>"))


def number_list(raw: Column) -> Column:
    """Sorted distinct numbers of ``7,12,15-17``; reversed ranges are fine, blanks are skipped."""
    parts = F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), ","), lambda p: F.trim(p)), lambda p: p != "")

    def numbers(p: Column) -> Column:
        ends = F.transform(F.split(p, "-"), lambda e: F.trim(e).cast("int"))
        return F.sequence(F.array_min(ends), F.array_max(ends))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, numbers))))


def slice_indices(n: Column, k: Column) -> Column:
    """k indices spread over 0..n-1, truncated; one index is the middle."""
    spread = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.floor(i * (n - 1) / F.greatest(k - 1, F.lit(1))).cast("int"))
    return F.when(k == 1, F.array(F.floor(n / 2).cast("int"))).otherwise(spread)


def centre(raw: Column, sizes: Column, strict: bool = False) -> Column:
    """``z,y,x`` or the middle of each axis, clamped into the shape; if strict, a centre outside is an error."""
    given = F.transform(F.split(raw, ","), lambda c: F.trim(c).cast("int"))
    middle = F.transform(sizes, lambda n: F.floor(n / 2).cast("int"))
    wrong = F.raise_error(F.concat(F.lit("centre outside the volume: "), raw)).cast("int")

    def within(i: Column, n: Column) -> Column:
        return F.when((i >= 0) & (i < n), i).otherwise(wrong) if strict else F.least(F.greatest(i, F.lit(0)), n - 1)

    return F.zip_with(F.coalesce(given, middle), sizes, within)


def target_to_source(index: int, start: int, factor: int) -> int:
    """The first source index of an output index."""
    return start + index * factor


def plane_list(raw: Column) -> Column:
    """Lower-case names of ``xy, XZ``, in their order; blanks are skipped, null is none."""
    parts = F.transform(F.split(F.coalesce(raw, F.lit("")), ","), lambda p: F.lower(F.trim(p)))
    return F.filter(parts, lambda p: p != "")


def unknown_planes(planes: Column) -> Column:
    return F.array_except(planes, F.array(*map(F.lit, PLANES)))


def checked_planes(raw: Column) -> Column:
    """plane_list; a name that is no plane is an error."""
    found = plane_list(raw)
    wrong = F.raise_error(F.concat(F.lit("no such planes: "), F.array_join(unknown_planes(found), ", ")))
    return F.when(F.size(unknown_planes(found)) == 0, found).otherwise(wrong.cast("array<string>"))


def sampling_step(voxels: int, target: int) -> int:
    """The stride at which a cube of so many voxels has about target samples."""
    if target <= 0:
        return 1
    step = max(1, round((voxels / target) ** (1 / 3)))
    while step > 1 and (step - 1) ** 3 * target >= voxels:
        step -= 1
    while step**3 * target < voxels:
        step += 1
    return step


def stride(voxels: Column, target: int) -> Column:
    """``sampling_step`` of a column: the least step, one at least, of which the cube times target reaches the voxels."""
    if target <= 0:
        return F.lit(1)
    near = F.greatest(F.round(F.cbrt(voxels / F.lit(float(target)))).cast("bigint"), F.lit(1))
    enough = [(near + k) * (near + k) * (near + k) * F.lit(target) >= voxels for k in (-1, 0)]
    step = F.when(enough[0], near - 1).when(enough[1], near).otherwise(near + 1)
    return F.greatest(step, F.lit(1)).cast("int")


def check_request(**options: float | str | bool | None) -> None:
    """Options of a run that go together wrongly; names are those of the settings.

    One output name is for one volume, so not for a range; a fixed display range needs its lower bound first;
    compression levels run from 0 to 9; raw frames alone leave no room for a preview or stage timings.
    """
    def given(*names: str) -> bool:
        return any(options.get(n) not in (None, False) for n in names)

    check_options(**{n: options.get(n) for n in ("factor", "jobs", "frame_factor", "frames_per_second", "interval", "max_events", "min_event", "min_component")})
    wrong = []
    if given("output_name") and given("start", "stop"):
        wrong.append("output_name names one volume, so there is no range")
    if not given("preview_only") and "output" in options and not given("output"):
        wrong.append("output is needed unless preview_only is set")
    if (level := options.get("level")) is not None and not 0 <= level <= 9:
        wrong.append("level lies between 0 and 9")
    low, high = options.get("display_min"), options.get("display_max")
    if low is not None and high is not None and not low < high:
        wrong.append("display_min lies below display_max")
    wrong += [f"{n} must not be below zero" for n in ("merge_gap", "noise_floor", "floor_fraction") if (options.get(n) or 0) < 0]
    if given("frames_only") and given("preview", "stage_times"):
        wrong.append("frames_only leaves out preview and stage_times")
    if wrong:
        raise ValueError("; ".join(wrong))


def check_options(**options: float | None) -> None:
    """Numbers that have to be above zero, if given."""
    wrong = [k for k, v in options.items() if v is not None and not v > 0]
    if wrong:
        raise ValueError(f"{', '.join(wrong)} must be above zero")
