"""Typed tables of runs, comparisons and events, which can be written again without doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema, storage
from .operators.events import PAIR

#: Types of the columns that are not strings.
_TYPES = {
    "timestamp": "created_at",
    "timestamp_ntz": "previous_reconstruction_mtime reconstruction_mtime",
    "int": """start_number stop_number min_event_size min_slice_component_size merge_gap crop_z_start crop_y_start crop_x_start max_events
        sequence_number previous_sequence_number event_rank z_min z_max y_min y_max x_min x_max full_z_min full_z_max full_y_min full_y_max
        full_x_min full_x_max""",
    "bigint": "detected_event_count stored_event_count voxel_count",
    "double": """baseline_sigma threshold_sigma threshold_value max_abs_diff peak_abs_diff peak_signed_diff mean_abs_diff mean_signed_diff z_centroid
        y_centroid x_centroid full_z_centroid full_y_centroid full_x_centroid""",
}
_TYPE_OF = {column: kind for kind, columns in _TYPES.items() for column in columns.split()}
#: Columns of each table; run_id and, but for runs, sequence_number are its partitions.
TABLES = {
    "runs": [*schema.RUNS, "run_id"],
    "comparisons": schema.COMPARISONS,
    "events": [*schema.EVENTS, "run_id", "sequence_number"],
}
PARTITIONS = {"runs": ["run_id"], "comparisons": ["run_id", "sequence_number"], "events": ["run_id", "sequence_number"]}
#: Columns of the exported file, of the comparison and of its event.
EXPORT = """sequence_number previous_sequence_number dataset_root previous_dataset_root reconstruction_file previous_reconstruction_file
    reconstruction_mtime previous_reconstruction_mtime event_rank voxel_count peak_abs_diff peak_signed_diff mean_abs_diff mean_signed_diff
    z_centroid y_centroid x_centroid z_min z_max y_min y_max x_min x_max full_z_centroid full_y_centroid full_x_centroid full_z_min full_z_max
    full_y_min full_y_max full_x_min full_x_max""".split()


def ddl(table: str) -> str:
    return ", ".join(f"{c} {_TYPE_OF.get(c, 'string')}" for c in TABLES[table])


def conformed(df: DataFrame, table: str) -> DataFrame:
    """df with exactly the table's columns and types; those that it lacks are null, others are an error."""
    if unknown := set(df.columns) - set(TABLES[table]):
        raise ValueError(f"{table} has no columns {', '.join(sorted(unknown))}")
    return df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(_TYPE_OF.get(c, "string")).alias(c) for c in TABLES[table]))


def save(df: DataFrame, root: str, table: str) -> None:
    """Write the table's rows; partitions (a run, or a comparison of a run) that df has are replaced, others stay."""
    by = PARTITIONS[table]
    rows = conformed(df, table).repartition(*by).sortWithinPartitions(*by)
    storage.replace(rows, f"{root}/{table}", by)


def rewrite(df: DataFrame, root: str, table: str) -> None:
    """The table with df's rows alone."""
    rows = conformed(df, table).repartition(*PARTITIONS[table])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*PARTITIONS[table]).parquet(f"{root}/{table}")


def load(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table, empty where nothing has been written."""
    return storage.load(spark, f"{root}/{table}", ddl(table))


def comparison_rows(pairs: DataFrame, compared: DataFrame) -> DataFrame:
    """Rows of comparisons. pairs: described members (``catalog.described_pairs``); compared: ``events.comparison_rows``."""
    names = {
        "seq": "sequence_number", "prev_seq": "previous_sequence_number", "dataset_name": "dataset_root", "prev_dataset_name": "previous_dataset_root",
        "file_name": "reconstruction_file", "prev_file_name": "previous_reconstruction_file", "mtime": "reconstruction_mtime", "prev_mtime": "previous_reconstruction_mtime",
    }
    rows = pairs.join(compared, PAIR).withColumns({"run_id": F.col("series"), "id": F.concat_ws("/", "series", "seq")})
    return rows.withColumnsRenamed(names).select(*TABLES["comparisons"])


def event_rows(described: DataFrame) -> DataFrame:
    """Rows of events, from ``events.described``; each names its comparison."""
    comparison = F.concat_ws("/", "series", "seq")
    rows = described.withColumns({"run_id": F.col("series"), "sequence_number": F.col("seq"), "comparison_id": comparison, "id": F.concat_ws("/", comparison, F.col("event_rank"))})
    return rows.select(*TABLES["events"])


def orphans(runs: DataFrame, comparisons: DataFrame, events: DataFrame) -> DataFrame:
    """(table, id, missing): comparisons without their run, and events without their comparison."""
    lone = comparisons.join(runs.select("run_id").distinct(), "run_id", "left_anti")
    lost = events.join(comparisons.select(F.col("id").alias("comparison_id")).distinct(), "comparison_id", "left_anti")
    return lone.select(F.lit("comparisons").alias("table"), "id", F.col("run_id").alias("missing")).union(lost.select(F.lit("events").alias("table"), "id", F.col("comparison_id").alias("missing")))


def export(comparisons: DataFrame, events: DataFrame) -> DataFrame:
    """The exported columns of every event, ordered by comparison and rank; comparisons without events have no row."""
    one = comparisons.select(*EXPORT[:8], F.col("id").alias("comparison_id"), "run_id")
    rows = one.join(events.drop("id", "run_id", "sequence_number"), "comparison_id")
    return rows.orderBy("run_id", "sequence_number", "event_rank").select(*EXPORT)
