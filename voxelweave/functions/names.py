"""Names of datasets, series, positions and files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def series_name(dataset: Column) -> Column:
    """The name without its four-digit suffix."""
    return F.regexp_replace(dataset, r"_\d{4}$", "")


def sequence_number(dataset: Column, pattern: str = r"_(\d{4})$") -> Column:
    """The suffix as a number, 0 without one; the live view takes any number of digits."""
    return F.coalesce(F.regexp_extract(dataset, pattern, 1).try_cast("int"), F.lit(0))


def position_name(dataset: Column, collection: Column) -> Column:
    series, prefix = series_name(dataset), F.concat(collection, F.lit("_"))
    return F.when(F.startswith(series, prefix), F.substring(series, F.length(prefix) + 1, F.length(series))).otherwise(series)


def dataset_root(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/reconstructed_volumes/", 1)


def is_volume_file(name: Column) -> Column:
    return ~F.contains(F.lower(name), F.lit("histogram"))


def output_name(dataset: Column) -> Column:
    return F.concat(dataset, F.lit("_compressed.hdf5"))


def frame_label(seq: Column, previous: Column) -> Column:
    return F.format_string("#%04d prev #%04d", seq, previous)


def iso_utc(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def scan_kind(image_key: Column) -> Column:
    return F.when(image_key == 0, "projection").when(image_key == 1, "flat").when(image_key == 2, "dark").otherwise("unknown")


def comparison_position_name(mode: Column, reference: Column, chosen: Column) -> Column:
    """The position that a comparison is held to: the chosen target's, else the reference's; none unless the mode is same."""
    return F.when(mode == "same", F.coalesce(chosen, reference))


def display_title(reference: Column, reference_file: Column, current: Column, current_file: Column) -> Column:
    """Two lines: dataset and file of the reference, and of what is shown."""
    return F.format_string("reference: %s | %s\ncurrent: %s | %s", reference, reference_file, current, current_file)
