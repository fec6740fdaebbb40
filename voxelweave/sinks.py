"""Result tables: runs, comparisons and events as Parquet, and the CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema
from .operators import events as ev


def write_run(spark: SparkSession, root: str, run_id: str, settings: dict[str, str]) -> None:
    """One row in runs; unknown settings are an error, missing ones are null."""
    unknown = set(settings) - set(schema.RUNS)
    if unknown:
        raise ValueError(f"no such columns: {', '.join(sorted(unknown))}")
    row = {c: F.lit(settings.get(c)).cast("string").alias(c) for c in schema.RUNS if c not in ("id", "created_at")}
    spark.range(1).select(F.lit(run_id).alias("id"), F.current_timestamp().alias("created_at"), *row.values()).write.mode("append").parquet(f"{root}/runs")


def write_comparisons(comparisons: DataFrame, root: str, run_id: str) -> None:
    rows = comparisons.withColumns({"run_id": F.lit(run_id), "id": F.concat_ws("/", F.lit(run_id), "series", "seq")})
    rows.withColumnsRenamed({"seq": "sequence_number", "prev_seq": "previous_sequence_number"}).write.mode("append").partitionBy("run_id").parquet(f"{root}/comparisons")


def write_events(events: DataFrame, root: str, run_id: str) -> None:
    rows = events.withColumns({"run_id": F.lit(run_id), "comparison_id": F.concat_ws("/", F.lit(run_id), "series", "seq")})
    rows.write.mode("append").partitionBy("run_id").parquet(f"{root}/events")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A result table over all runs; columns that older runs lack are null."""
    return spark.read.option("mergeSchema", True).parquet(f"{root}/{name}")


def with_declared(df: DataFrame, declared: list[str]) -> DataFrame:
    """df with the declared columns that it lacks, as nulls."""
    return df.withColumns({c: F.lit(None).cast("string") for c in declared if c not in df.columns})


def export_csv(comparisons: DataFrame, events: DataFrame, path: str) -> None:
    """The joined rows, ordered; a range sort keeps the order over part files."""
    ev.export_rows(comparisons, events).write.option("header", True).csv(path)
