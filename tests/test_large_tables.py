"""Queries against their SQL where numbers outgrow the digits of names and where the last volume lacks planes."""

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import queries as jobs
from voxelweave.functions import scalars
from voxelweave.plans import queries
from voxelweave.plans.oracle import ORACLE
from voxelweave.plans.queries import QUERIES
from voxelweave.sources import volumes

DATA = "/root/testdata/sf0.001"
TABLES = "events lineitem embeddings".split()
#: Catalog queries, over one series of which the numbers go beyond 9,999.
MANY_MEMBERS = "file_times latest_files newest_dataset pairs_lag plane_lists second_targets series_names skip_list".split()

#: Queries over listings of scans of which the numbers go beyond 999,999.
MANY_SCANS = "projection_datasets resolved_scans".split()

#: Queries of volumes, of which the last one lacks planes.
PART_OF_A_VOLUME = "output_sizes preview_slice_strided suggested_settings".split()


@pytest.fixture(scope="module")
def cut_short(spark, tmp_path_factory):
    """Six volumes, of which the last one has ten planes of twenty."""
    folder = f"file://{tmp_path_factory.mktemp('short')}"
    spark.read.parquet(f"{DATA}/embeddings.parquet").where("vec_id < 110").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """A folder of tables: one series of 10,400 datasets, and scans below and beyond number 1,000,000."""
    folder = f"file://{tmp_path_factory.mktemp('large')}"
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).cast("timestamp_ntz")
    events = spark.range(31_200).select(F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") * 5).alias("user_id"), F.lit("view").alias("event_type"), (F.col("id") % 5000 / 7).alias("value"), F.lit("{}").alias("props"))
    events.write.parquet(f"{folder}/events.parquet")
    lines = spark.range(6_000).select((F.floor(F.col("id") / 3) + F.when(F.col("id") < 3000, 80).otherwise(1_200_000)).alias("l_orderkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"), (F.col("id") % 50 + 1.0).alias("l_quantity"))
    lines.write.parquet(f"{folder}/lineitem.parquet")
    return folder


def compare(spark, folder, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    got = QUERIES[name](spark, folder)
    for t in TABLES:
        if spark._jvm.java.io.File(f"{folder.removeprefix('file://')}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder.removeprefix('file://')}/{t}.parquet/*.parquet'")
    want = con.execute(ORACLE[name])
    at = [d[0] for d in want.description]
    columns = sorted(got.columns)
    assert sorted(at) == columns
    there = sorted((tuple(r[at.index(c)] for c in columns) for r in want.fetchall()), key=repr)
    here = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    assert here == there and here


@pytest.mark.parametrize("name", MANY_MEMBERS)
def test_numbers_of_five_digits(spark, large, name):
    compare(spark, large, name)


@pytest.mark.parametrize("name", MANY_SCANS)
def test_scans_of_seven_digits(spark, large, name):
    compare(spark, large, name)


@pytest.mark.parametrize("name", PART_OF_A_VOLUME)
def test_a_last_volume_without_all_planes(spark, cut_short, name):
    compare(spark, cut_short, name)


def test_a_member_that_waits_is_in_the_output_of_the_job(spark, tmp_path):
    """Volume 16, number 5 of its series, has ten planes of twenty."""
    spark.read.parquet(f"{DATA}/embeddings.parquet").where("vec_id < 330").write.parquet(f"file://{tmp_path}/embeddings.parquet")
    spark.read.parquet(f"{DATA}/events.parquet").write.parquet(f"file://{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in ("events", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = jobs.QUERIES["job1_track_series"](spark, f"file://{tmp_path}")
    want = con.execute(jobs.ORACLE["job1_track_series"])
    at = [d[0] for d in want.description]
    there = sorted((tuple(r[at.index(c)] for c in got.columns) for r in want.fetchall()), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == there
    assert max(r.sequence_number for r in got.where("run_id = 'c1_click'").collect()) == 5


def test_rounding_is_that_of_the_sql(spark):
    values = [k / 20_000 + d for k in range(9_000, 12_000, 7) for d in (0.0, 1e-9, -1e-9)]
    want = [duckdb.execute("SELECT list_transform(?, lambda v: round(v, 4))", [values]).fetchall()[0][0]]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v double").withColumn("r", scalars.rounded(F.col("v"), 4)).orderBy("i").collect()
    assert [[r.r for r in rows]] == want


def test_files_of_a_store_do_not_grow_with_members(spark):
    """25 volumes in 8 buckets: a span of members has one file for each bucket."""
    tiles = volumes.tiles_of_vectors(spark.read.parquet(f"{DATA}/embeddings.parquet"))
    store = queries._store(spark, DATA, tiles)
    assert len(store.inputFiles()) <= 8 and store.count() == 500
