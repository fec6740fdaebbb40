"""Job: track events in series of volumes that grow, and keep their tables up to date.

    spark-submit jobs/track_series.py --config jobs/track_series.json --vectors PATH --files PATH --out PATH

Reads the volumes (a table of dense vectors, each a plane) and the catalog of their files, and compares
each admitted member with the one before. A run takes only members beyond the mark that the last one left for
their series: it reads those and the one member before them. Under --out it writes

    runs          a row for each series: settings, the noise of its first pair and the threshold of all pairs
    comparisons   a row for each pair, by series (run_id) and sequence_number
    events        the ranked events of each pair, likewise
    marks         the last sequence number that is done, by series
    pending       runs, comparisons and events of members that wait: provisional, worked out anew by each run

Each write replaces whole partitions and the mark comes last. So a run that broke off, or is started again,
gives the same tables. A member whose planes are not all there holds back the mark, and those after it, until they are;
till then its comparison is made with the planes that it has and kept under pending, of which no row counts up to the
mark. Numbers of a series only grow: a file that turns up for a number below the mark is not looked at.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from voxelweave import runs, storage
from voxelweave.functions import ranges, scalars
from voxelweave.operators import catalog
from voxelweave.plans import tracking
from voxelweave.shipping import ship
from voxelweave.sources import files as listings
from voxelweave.sources import volumes

CONFIG = Path(__file__).with_suffix(".json")
MARKS = "done int, run_id string"
log = logging.getLogger("jobs.track_series")


def settings(config: dict) -> tuple[tracking.Options, tracking.Crop]:
    crop = tracking.Crop(**{a: tuple(r) for a, r in (config.get("crop") or {}).items() if r})
    named = ("threshold_sigma", "min_component", "min_event", "merge_gap", "max_events")
    return tracking.Options(**{n: config[n] for n in named if n in config}, crop_start=crop.start), crop


def marks(spark: SparkSession, out: str) -> DataFrame:
    """(series, done), empty before the first run."""
    return storage.load(spark, f"{out}/marks", MARKS).select(F.col("run_id").alias("series"), "done")


def member_pairs(listed: DataFrame, tiles: DataFrame, config: dict) -> DataFrame:
    """Pairs of admitted members that have planes, with final: both lie before the first member of their series whose planes are not all there."""
    skipped = listed.sparkSession.range(1).select(F.explode(ranges.number_list(F.lit(config.get("skip")))).alias("seq"))
    members = catalog.admitted(listed, skipped, config.get("start"), config.get("stop")).withColumn("series", F.concat_ws("_", *catalog.SERIES))
    planes = tiles.groupBy("series", "seq").agg(F.count_distinct("z").alias("planes"))
    rows = members.join(planes, ["series", "seq"], "left").withColumn("whole", F.coalesce(F.col("planes") == config["depth"], F.lit(False)))
    first = rows.where("not whole").groupBy("series").agg(F.min("seq").alias("stuck"))
    pairs = catalog.described_pairs(rows.where("planes is not null").select(*members.columns))
    return pairs.join(first, "series", "left").withColumn("final", F.coalesce(F.col("seq") < F.col("stuck"), F.lit(True))).drop("stuck")


def run_rows(fresh: DataFrame, thresholds: DataFrame, config: dict, options: tracking.Options) -> DataFrame:
    """Rows of runs for the series that start now: its first pair's reference, settings and noise."""
    first = fresh.groupBy("series").agg(F.min_by(F.struct("prev_dataset_name", "prev_file_name"), "seq").alias("r"))
    values = {
        "id": F.col("series"), "run_id": F.col("series"), "created_at": F.current_timestamp(), "reference_dataset_root": F.col("r.prev_dataset_name"),
        "reference_reconstruction_file": F.col("r.prev_file_name"), "start_number": F.lit(config.get("start")), "stop_number": F.lit(config.get("stop")),
        "skipped_scans": F.lit(config.get("skip")), "baseline_sigma": F.col("baseline_sigma"), "threshold_sigma": F.lit(options.threshold_sigma),
        "threshold_value": F.col("threshold"), "min_event_size": F.lit(options.min_event), "min_slice_component_size": F.lit(options.min_component),
        "merge_gap": F.lit(options.merge_gap), "max_events": F.lit(options.max_events),
        **{f"crop_{a}_start": F.lit(s) for a, s in zip("zyx", options.crop_start, strict=True)},
    }
    return first.join(thresholds, "series").select(*(v.alias(c) for c, v in values.items()))


def run(spark: SparkSession, vectors: str, files: str, out: str, config: dict) -> None:
    """Bring the tables under out up to date with the volumes and files that are there now."""
    ship(spark)
    options, crop = settings(config)
    tiles = volumes.volumes_of_vectors(spark.read.parquet(vectors), config["series"], config["depth"])
    listed = listings.catalog_of_events(spark.read.parquet(files))
    listed = listed.where(F.concat_ws("_", *catalog.SERIES).isin(config["series"]))
    done = marks(spark, out)
    pairs = member_pairs(listed, tiles, config)
    pairs = storage.materialize(pairs.join(done, "series", "left").where("done is null or seq > done").drop("done"), "new-pairs")
    new, waiting = (pairs.where(f).drop("final") for f in ("final", "not final"))
    n, w = new.count(), waiting.count()
    log.info("read %s and %s: %d new pairs, %d with a member that waits for planes", vectors, files, n, w)
    if not n + w:
        log.info("nothing new, %s stays as it is", out)
        return
    if n:
        fresh = new.join(noise(runs.load(spark, out, "runs")), "series", "left_anti")
        if not fresh.isEmpty():
            measured = tracking.thresholds_of_pairs(tiles, fresh, options, crop)
            runs.save(run_rows(fresh, measured, config, options), out, "runs")
        found = compared(tiles, new, noise(runs.load(spark, out, "runs")), options, crop)
        runs.save(runs.event_rows(found.ranked), out, "events")
        runs.save(runs.comparison_rows(new, found.compared), out, "comparisons")
        last = new.groupBy(F.col("series").alias("run_id")).agg(F.max("seq").alias("done")).select("done", "run_id")
        storage.replace(last, f"{out}/marks", ["run_id"])
    provisional(spark, tiles, waiting if w else None, out, config)
    for table in ("runs", "comparisons", "events"):
        log.info("wrote %s/%s: %d rows now", out, table, runs.load(spark, out, table).count())


def noise(rows: DataFrame) -> DataFrame:
    """(series, baseline_sigma, threshold) of rows of runs."""
    return rows.select(F.col("run_id").alias("series"), "baseline_sigma", F.col("threshold_value").alias("threshold"))


def compared(tiles: DataFrame, pairs: DataFrame, known: DataFrame, options: tracking.Options, crop: tracking.Crop) -> tracking.Found:
    return tracking.find(tracking.diffs_of_pairs(tiles, pairs, crop).join(storage.few(known), "series"), options)


def provisional(spark: SparkSession, tiles: DataFrame, waiting: DataFrame | None, out: str, config: dict) -> None:
    """Tables of the pairs that wait, in place of those of the last run; a series that has no run yet gets a provisional one."""
    options, crop = settings(config)
    root = f"{out}/pending"
    if waiting is None:
        for table in runs.TABLES:
            runs.rewrite(spark.createDataFrame([], runs.ddl(table)), root, table)
        return
    known = runs.load(spark, out, "runs")
    fresh = waiting.join(noise(known), "series", "left_anti")
    some = known.limit(0)
    if not fresh.isEmpty():
        some = run_rows(fresh, tracking.thresholds_of_pairs(tiles, fresh, options, crop), config, options)
    runs.rewrite(some, root, "runs")
    found = compared(tiles, waiting, noise(known).unionByName(noise(runs.load(spark, root, "runs"))), options, crop)
    runs.rewrite(runs.event_rows(found.ranked), root, "events")
    runs.rewrite(runs.comparison_rows(waiting, found.compared), root, "comparisons")


def with_pending(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Each table with the provisional rows beyond the marks."""
    done = marks(spark, out).withColumnRenamed("series", "run_id")
    known, held = ({t: runs.load(spark, root, t) for t in runs.TABLES} for root in (out, f"{out}/pending"))
    held["runs"] = held["runs"].join(known["runs"].select("run_id"), "run_id", "left_anti")
    for t in ("comparisons", "events"):
        held[t] = held[t].join(done, "run_id", "left").where("done is null or sequence_number > done")
    return {t: known[t].unionByName(held[t].select(*known[t].columns)) for t in runs.TABLES}


def output(spark: SparkSession, out: str) -> DataFrame:
    """Every comparison, the provisional ones too, with its run's noise and its events (a row without one where it has none)."""
    tables = with_pending(spark, out)
    events = tables["events"].select("comparison_id", *runs.EXPORT[8:])
    rows = tables["comparisons"].withColumnRenamed("id", "comparison_id").join(events, "comparison_id", "left")
    rows = rows.join(tables["runs"].select("run_id", "baseline_sigma", "threshold_value"), "run_id")
    rows = rows.select("run_id", *runs.EXPORT, "detected_event_count", "stored_event_count", "max_abs_diff", "baseline_sigma", "threshold_value")
    rows = rows.withColumn("max_abs_diff", scalars.rounded(F.col("max_abs_diff"), 6))
    return rows.select(*(scalars.rounded(F.col(c), 4).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes))


def job1_track_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job, run twice over the whole tables into a new folder."""
    out, config = storage.new_path(spark, "job1"), json.loads(CONFIG.read_text())
    for _ in range(2):
        run(spark, f"{sf_dir}/embeddings.parquet", f"{sf_dir}/events.parquet", out, config)
    return output(spark, out)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--config", default=str(CONFIG))
    for name in ("vectors", "files", "out"):
        parser.add_argument(f"--{name}", required=True)
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("track_series").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, args.vectors, args.files, args.out, json.loads(Path(args.config).read_text()))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
