"""The flagship plan: from tiles and a file catalog to ranked events, and its result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranges import check_options
from ..operators import catalog, components, diff, events
from ..sources import volumes
from ..storage import few, materialize

Range = tuple[int, int]


@dataclass(frozen=True)
class Options:
    threshold_sigma: float = 5.0
    absolute_threshold: float | None = None
    min_component: int = 16
    min_event: int = 1000
    merge_gap: int = 10
    max_events: int = 100
    sampling_step: int | None = None  # from the volumes' size and sample_target
    sample_target: int = diff.SAMPLES
    crop_start: tuple[int, int, int] = (0, 0, 0)

    def __post_init__(self):
        check_options(threshold_sigma=self.threshold_sigma, absolute_threshold=self.absolute_threshold, min_component=self.min_component, min_event=self.min_event, max_events=self.max_events, sampling_step=self.sampling_step)
        if self.merge_gap < 0:
            raise ValueError("merge_gap must not be below zero")


#: For the small volumes of the test tables.
SMALL = Options(threshold_sigma=2.0, min_component=1, min_event=2, merge_gap=1)


def thresholds(diffs: DataFrame, options: Options) -> DataFrame:
    """(series, baseline_sigma, threshold): an absolute threshold, or one from the noise of the first pair for all pairs."""
    if options.absolute_threshold is not None:
        return diffs.select("series", F.lit(0.0).alias("baseline_sigma"), F.lit(options.absolute_threshold).alias("threshold")).distinct()
    sigma = diff.baseline_sigma(diffs, options.sampling_step, options.sample_target)
    checked = F.when((F.col("sigma") > 0) & (F.col("sigma") < float("inf")), F.col("sigma")).otherwise(F.raise_error(F.lit("the first pair has no noise to measure")).cast("double"))
    return sigma.select("series", checked.alias("baseline_sigma"), (checked * options.threshold_sigma).alias("threshold"))


def with_threshold(diffs: DataFrame, options: Options) -> DataFrame:
    """diffs with the threshold of their series."""
    if options.absolute_threshold is not None:
        return diffs.withColumns({"baseline_sigma": F.lit(0.0), "threshold": F.lit(options.absolute_threshold)})
    return diffs.join(few(materialize(thresholds(diffs, options), "thresholds")), "series")


def regions(diffs: DataFrame, options: Options) -> DataFrame:
    """The regions of every slice of every pair."""
    return components.tile_regions(with_threshold(diffs, options), options.min_component)


def track(diffs: DataFrame, options: Options = Options()) -> DataFrame:
    """Ranked events of every pair, with means, centroids and full coordinates."""
    found = events.assemble(regions(diffs, options), options.min_event, options.merge_gap)
    return events.described(events.ranked(found, options.max_events), options.crop_start)


def comparisons(diffs: DataFrame, options: Options = Options()) -> DataFrame:
    """A row per pair with its counts and largest difference."""
    return find(with_threshold(diffs, options), options).compared


@dataclass(frozen=True)
class Crop:
    """Part of the volumes that is looked at, [start, stop) of each axis."""

    z: Range | None = None
    y: Range | None = None
    x: Range | None = None

    @property
    def start(self) -> tuple[int, int, int]:
        return tuple(r[0] if r else 0 for r in (self.z, self.y, self.x))


def pairs_of_catalog(files: DataFrame, tiles: DataFrame, skipped: DataFrame | None = None, start: int | None = None, stop: int | None = None) -> DataFrame:
    """The pairs (``catalog.described_pairs``) of admitted members that have tiles, as a table of its own."""
    members = catalog.admitted(files, skipped, start, stop)
    there = tiles.select("series", "seq").distinct()
    members = members.withColumn("series", F.concat_ws("_", *catalog.SERIES)).join(there, ["series", "seq"], "left_semi").drop("series")
    return materialize(catalog.described_pairs(members), "pairs")


def diffs_of_pairs(tiles: DataFrame, pairs: DataFrame, crop: Crop = Crop()) -> DataFrame:
    """The differences of exactly these pairs, within the crop and in its coordinates.

    Only tiles of members in pairs are read (in a store, only their folders); a member's own predecessor in
    pairs is the one before it among them, so one window over tiles gives all differences.
    """
    pairs = pairs.select(*events.PAIR)
    members = pairs.select("series", "seq").union(pairs.select("series", F.col("prev_seq").alias("seq")))
    cropped = volumes.crop_tiles(volumes.of_members(tiles, members), crop.z, crop.y, crop.x)
    return diff.tile_diffs(cropped).join(few(pairs), events.PAIR, "left_semi")


def thresholds_of_pairs(tiles: DataFrame, pairs: DataFrame, options: Options, crop: Crop = Crop()) -> DataFrame:
    """``thresholds`` of each series in pairs; of the tiles only those of its first pair are read."""
    first = pairs.groupBy("series").agg(F.min_by(F.struct("seq", "prev_seq"), "seq").alias("p")).select("series", "p.*")
    return materialize(thresholds(diffs_of_pairs(tiles, first, crop), options), "thresholds")


@dataclass(frozen=True)
class Found:
    """What a run has found: a row for each pair, and its ranked events. Both come from one computation of events."""

    compared: DataFrame
    ranked: DataFrame


def find(diffs: DataFrame, options: Options) -> Found:
    """diffs: with threshold. The events are worked out once and written; all else is derived from them."""
    found = events.assemble(components.tile_regions(diffs, options.min_component), options.min_event, options.merge_gap)
    found = materialize(found, "events")
    maxima = materialize(diff.pair_maxima(diffs), "maxima")  # has every pair
    compared = events.comparison_rows(maxima.select(*events.PAIR), maxima, found, options.max_events)
    return Found(compared, events.described(events.ranked(found, options.max_events), options.crop_start))
