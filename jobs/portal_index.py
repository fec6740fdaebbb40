"""Job: follow the listing of a data portal and keep an index of its series.

    spark-submit jobs/portal_index.py --config jobs/portal_index.json --pages PATH --out PATH

Reads the pages that were added to a folder (or to what a pattern matches) since the last run, as a file
stream (its checkpoint knows which), and takes each as the entry of a member: collection, position, sequence
number, title and size. Under --out it writes

    entries       a row for each page, by batch and section
    parts         for each batch, a row for each series in it: entries, bytes, first and newest number
    checkpoint    which files have been read

A section is a position that the config names, or "other" (also for pages that are no entry). A batch that broke off
is written again under its own number, in place of what it had left. So a run that broke off, or is started
again, gives the same tables. ``series`` adds up the parts.
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

from voxelweave import storage
from voxelweave.shipping import ship
from voxelweave.sources import portal

CONFIG = Path(__file__).with_suffix(".json")
SERIES = ["collection", "position"]
ENTRIES = f"{portal.ENTRY}, batch int, section string"
PARTS = (
    "collection string, position string, entries bigint, bytes bigint, first_seq int, newest struct<seq:int,page_id:bigint,title:string,size:string>, "
    "batch int, section string"
)
log = logging.getLogger("jobs.portal_index")


def sectioned(entries: DataFrame, positions: list[str]) -> DataFrame:
    return entries.withColumn("section", F.when(F.col("position").isin(positions), F.col("position")).otherwise("other"))


def parts(entries: DataFrame) -> DataFrame:
    """What a batch says of each series; of pages with the newest number the last one counts."""
    newest = F.max_by(F.struct("seq", "page_id", "title", "size"), F.struct("seq", "page_id")).alias("newest")
    totals = [F.count(F.lit(1)).alias("entries"), F.sum("length").alias("bytes"), F.min("seq").alias("first_seq")]
    return entries.where("seq is not null").groupBy("section", *SERIES).agg(*totals, newest)


def run(spark: SparkSession, pages: str, out: str, config: dict) -> None:
    """Take in the pages that are new, and wait until all are."""
    ship(spark)

    def step(batch: DataFrame, number: int) -> None:
        session, by = batch.sparkSession, ["batch", "section"]
        rows = sectioned(portal.entries(batch), config["positions"])
        storage.replace(rows.withColumn("batch", F.lit(number)), f"{out}/entries", by)
        here = storage.load(session, f"{out}/entries", ENTRIES).where(F.col("batch") == number)  # the pages are read once
        storage.replace(parts(here).withColumn("batch", F.lit(number)), f"{out}/parts", by)
        log.info("batch %d: %d pages of %s, now in %s", number, here.count(), pages, out)

    stream = spark.readStream.schema(portal.PAGES).option("maxFilesPerTrigger", config["files_per_batch"]).parquet(pages)
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    log.info("all of %s is in %s", pages, out)


def series(spark: SparkSession, out: str) -> DataFrame:
    """A row for each series: entries, bytes, first number and newest entry."""
    rows = storage.load(spark, f"{out}/parts", PARTS)
    newest = F.max_by("newest", F.struct("newest.seq", "newest.page_id")).alias("newest")
    found = rows.groupBy(*SERIES).agg(F.sum("entries").alias("entries"), F.sum("bytes").alias("bytes"), F.min("first_seq").alias("first_seq"), newest)
    return found.select(*SERIES, "entries", "bytes", "first_seq", F.col("newest.seq").alias("newest_seq"), F.col("newest.page_id").alias("newest_page"))


def output(spark: SparkSession, out: str) -> DataFrame:
    """Every entry with what is known of its series."""
    rows = storage.load(spark, f"{out}/entries", ENTRIES).drop("batch")
    return rows.join(series(spark, out), SERIES, "left")


def job2_portal_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job, run twice over the whole table into a new folder."""
    out, config = storage.new_path(spark, "job2"), json.loads(CONFIG.read_text())
    for _ in range(2):
        run(spark, f"{sf_dir}/{{pages.parquet}}", out, config)  # as a pattern it may be a single file, too
    return output(spark, out)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--config", default=str(CONFIG))
    for name in ("pages", "out"):
        parser.add_argument(f"--{name}", required=True)
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("portal_index").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, args.pages, args.out, json.loads(Path(args.config).read_text()))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
