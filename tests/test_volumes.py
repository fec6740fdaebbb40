import math

import pytest
from pyspark.sql import functions as F

from voxelweave import sinks
from voxelweave.operators import diff, events, frames, slices, transform
from voxelweave.operators import components as comp
from voxelweave.plans import compression, screening, tracking
from voxelweave.sources import files, volumes

DATA = "/root/testdata/sf0.01"
TILE = "series string, seq int, z int, y0 int, x0 int, ny int, nx int, data array<float>"


def tile(spark, *planes, nx=2, series="s"):
    """planes: (seq, z, values)."""
    return spark.createDataFrame([(series, s, z, 0, 0, len(v) // nx, nx, [float(x) for x in v]) for s, z, v in planes], TILE)


@pytest.fixture(scope="module")
def vectors(spark):
    return volumes.tiles_of_vectors(spark.read.parquet(f"{DATA}/embeddings.parquet"))


def test_noise_and_statistics_from_a_stride(vectors):
    diffs = diff.tile_diffs(vectors)
    # 1,280 voxels and a target of 160: every second voxel on each axis
    derived, given = diff.baseline_sigma(diffs, target=160).head().sigma, diff.baseline_sigma(diffs, 2).head().sigma
    shifted = diff.baseline_sigma(diffs, 2, start=(1, 1, 1)).head().sigma
    d = diff.voxel_diffs(diffs).where("seq = 1").toPandas()

    def plain(at):
        v = d[(d.z % 2 == at) & (d.y % 2 == at) & (d.x % 2 == at)].d.astype(float)
        return (v - v.median()).abs().median() / diff.NORMAL_QUARTILE

    assert derived == given == pytest.approx(plain(0)) and shifted == pytest.approx(plain(1)) and shifted != given
    rows = volumes.voxels(vectors)
    assert transform.statistics(rows, target=160).orderBy("seq").collect() == transform.statistics(rows, 2).orderBy("seq").collect()
    assert transform.statistics(rows, target=160).head().n == 160 and transform.statistics(rows).head().n == 1280


def test_counts_of_the_fixture(vectors):
    diffs = diff.tile_diffs(vectors)
    assert diffs.select("seq").distinct().count() == 24 and diff.voxel_diffs(diffs).count() == 30_720
    assert round(diff.baseline_sigma(diffs).head().sigma, 6) == 0.179237
    cells = diff.masked(tracking.with_threshold(diffs, tracking.SMALL), F.col("threshold"))
    assert cells.count() == 1344
    regions = tracking.regions(diffs, tracking.SMALL).cache()
    assert regions.count() == 1184
    assert events.assemble(regions, 1, 1).count() == 785 and events.assemble(regions, 2, 1).count() == 217
    assert events.assemble(regions, 1, 1).agg(F.sum("voxel_count"), F.max("voxel_count")).head()[:] == (1344, 32)


def test_tiles_and_voxels_round_trip(vectors):
    some = vectors.where("seq < 3")
    back = volumes.tiles(volumes.voxels(some), 3, 5)
    assert volumes.voxels(back).exceptAll(volumes.voxels(some)).count() == 0 and back.count() == 60 * 3 * 2
    assert volumes.shapes(back).where("complete").count() == 3
    assert volumes.shapes(back.where("not (z = 3 and y0 = 3)")).where("complete").count() == 0


def test_tile_table(spark, vectors, tmp_path):
    volumes.write_tiles(vectors, f"file://{tmp_path}/t", "none")
    back = volumes.read_tiles(spark, f"file://{tmp_path}/t")
    assert back.count() == 500
    plan = back.where("seq = 3 and z = 4")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(seq" in plan and "EqualTo(z,4)" in plan


def test_nan_is_never_masked_and_hides_its_slice(spark):
    t = tile(spark, (0, 0, [0, 0, 0, 0]), (1, 0, [math.nan, 9, 0, 0]), (0, 1, [0] * 4), (1, 1, [0, 0, -4, 0]))
    diffs = diff.tile_diffs(t)
    assert sorted((r.z, r.y, r.x, r.d) for r in diff.masked(diffs, F.lit(4.0)).collect()) == [(0, 0, 1, 9.0), (1, 1, 0, -4.0)]
    assert diff.pair_maxima(diffs).head().max_abs_diff == 4.0
    assert diff.preview_slice(diffs).head().z == 1


def test_shape_mismatch(spark):
    t = tile(spark, (0, 0, [0, 0]), (1, 0, [0, 0, 1, 1]))
    with pytest.raises(Exception, match="differ in shape"):
        diff.tile_diffs(t).collect()
    assert [r.seq for r in diff.mismatched(volumes.shapes(t)).collect()] == [1]


def test_sigma_falls_back_to_the_deviation(spark):
    rows = spark.createDataFrame([("a", 0.0)] * 9 + [("a", 10.0)], "k string, d double")
    assert diff.robust_sigma(rows, ["k"]).head().sigma == pytest.approx(3.0)
    flat = diff.tile_diffs(tile(spark, (0, 0, [1, 1, 1, 1]), (1, 0, [2, 2, 2, 2])))
    with pytest.raises(Exception, match="no noise"):
        tracking.with_threshold(flat, tracking.SMALL).collect()
    absolute = tracking.Options(absolute_threshold=1.0, min_component=1, min_event=1)
    assert tracking.track(flat, absolute).head().voxel_count == 4
    assert tracking.with_threshold(flat, absolute).head().baseline_sigma == 0.0


@pytest.mark.parametrize("bad", [{"threshold_sigma": 0}, {"min_event": 0}, {"merge_gap": -1}])
def test_options(bad):
    with pytest.raises(ValueError, match="must"):
        tracking.Options(**bad)


def test_eight_neighbours_and_first_peak(spark):
    # two regions: a diagonal chain that closes below, and a single cell
    cells = [(0, 0), (1, 1), (0, 2), (3, 0), (2, 2)]
    rows = spark.createDataFrame([("s", 1, 0, 5, y, x, -2.0 if (y, x) == (0, 2) else 2.0) for y, x in cells], "series string, seq int, prev_seq int, z int, y int, x int, d float")
    out = sorted(tuple(r) for r in comp.aggregated(comp.labelled(rows), 1).select("y_min", "y_max", "x_min", "x_max", "voxel_count", "peak_signed_diff", "sum_signed_diff", "z_weighted_sum").collect())
    assert out == [(0, 2, 0, 2, 4, 2.0, 4.0, 20.0), (3, 3, 0, 0, 1, 2.0, 2.0, 5.0)]
    assert comp.aggregated(comp.labelled(rows), 2).count() == 1


def test_block_mean_ragged(spark):
    v = volumes.voxels(tile(spark, (0, 0, [1, 2, 3, 4, 5]), nx=5))
    out = transform.block_mean(v, 2, ("x",)).orderBy("x").collect()
    assert [r.v for r in out] == [1.5, 3.5, 5.0]


def test_reduction_options(spark, vectors):
    with pytest.raises(ValueError, match="bounds"):
        compression.Options(uint8=True)
    with pytest.raises(ValueError, match="mode"):
        compression.Options(mode="median")
    out = compression.reduce_volumes(volumes.voxels(vectors), compression.Options(factor=3, clip_min=0.0))
    assert out.count() == 25 * 7 * 3 * 3 and out.agg(F.min("v")).head()[0] == 0.0
    shape = F.array(F.lit(20), F.lit(300), F.lit(8))
    row = spark.range(1).select(transform.chunk_shape(shape), transform.chunk_shape(shape, y=64)).head()
    assert row[:] == ([8, 256, 8], [20, 64, 8])


def test_stored_types(spark):
    rows = spark.createDataFrame([("s", 0, 0, 0, 0, 2.75)], "series string, seq int, z int, y int, x int, v double")
    assert compression.stored(rows, "int", compression.Options()).head().v == 2 and compression.output_type("float", compression.Options()) == "float"
    assert compression.output_type("int", compression.Options(uint8=True, clip_min=0.0, clip_max=1.0)) == "smallint"


def test_centre_crop(spark):
    a = spark.createDataFrame([(0, 0, x, float(x)) for x in range(5)], "key int, y int, x int, v float")
    b = spark.createDataFrame([(0, 0, x, 0.0) for x in range(2)], "key int, y int, x int, v float")
    assert sorted((r.x, r.d) for r in diff.aligned_planes(a, b).collect()) == [(0, 1.0), (1, 2.0)]
    assert sorted((r.x, r.d) for r in diff.aligned_planes(b, a).collect()) == [(0, -1.0), (1, -2.0)]


def test_planes(spark, vectors):
    v = volumes.voxels(vectors.where("seq = 0"))
    assert slices.orthogonal(v, (1, 2, 3)).groupBy("plane").count().count() == 3
    assert slices.orthogonal(v, (1, 2, 3), fast=True).where("plane = 'yz'").count() == 0
    assert slices.strided(v, 3).where("z = 0").count() == 9
    f = frames.side_by_side(v.where("z = 0").select("seq", "y", "x", "v"), v.where("z = 1 and y < 2").select("seq", "y", "x", "v"), ["seq"])
    assert f.count() == 8 * (8 + 4 + 8) and f.where("x between 8 and 11 and v = 1").count() == 32


def test_result_tables(spark, vectors, tmp_path):
    root = f"file://{tmp_path}"
    diffs = diff.tile_diffs(vectors.where("seq < 4"))
    found, pairs = tracking.track(diffs, tracking.SMALL), tracking.comparisons(diffs, tracking.SMALL)
    sinks.write_run(spark, root, "r1", {"merge_gap": "1"})
    with pytest.raises(ValueError, match="no such"):
        sinks.write_run(spark, root, "r2", {"gap": "1"})
    sinks.write_comparisons(pairs, root, "r1")
    sinks.write_events(found, root, "r1")
    n = sinks.read_table(spark, root, "events").count()
    assert n == found.count() and sinks.read_table(spark, root, "comparisons").count() == 3
    assert sinks.read_table(spark, root, "comparisons").agg(F.sum("stored_event_count")).head()[0] == n
    assert sinks.read_table(spark, root, "runs").head().merge_gap == "1"
    sinks.export_csv(pairs, found, f"{root}/csv")
    assert spark.read.option("header", True).csv(f"{root}/csv").count() == n
    assert "max_events" in sinks.with_declared(pairs, ["max_events"]).columns


def test_screening(spark, vectors):
    some = vectors.where("seq < 3")
    raw = screening.raw_frames(some, (10, 4, 3))
    assert raw.count() == 3 * (64 + 160 + 160) and raw.agg(F.min("v"), F.max("v")).head()[:] == (0.0, 1.0)
    both = screening.comparison_frames(some, (10, 4, 3), 0.1, fast=True)
    assert both.groupBy("plane", "seq").count().collect() and both.where("plane = 'xy'").count() == 2 * 8 * 20
    pairs = diff.tile_diffs(some).select("series", "seq", "prev_seq")
    assert sorted(r.label for r in screening.labels(pairs).collect()) == ["#0001 prev #0000", "#0002 prev #0001"]


def test_choosing_datasets_and_files(spark):
    entries = spark.createDataFrame([("f", "/a", "f", [2, 3, 4], {"interpretation": "image"}), ("f", "/b", "f", [2, 3, 4], {}), ("g", "/z/data", "u", [2, 2, 2, 2], {})], "file string, name string, kind string, shape array<int>, attrs map<string,string>")
    assert files.chosen_dataset(entries.where("file = 'f'"), "/b").head().name == "/b"
    with pytest.raises(Exception, match="no volume /b in g"):
        files.chosen_dataset(entries, "/b").collect()
    assert {r.file: r.name for r in files.image_stacks(entries).collect()} == {"f": "/a", "g": "/z/data"}
    assert files.image_stacks(entries.where("file = 'f'"), "/b").head().name == "/b"
    with pytest.raises(Exception, match="no image stack /b in g"):
        files.image_stacks(entries, "/b").collect()
    paths = spark.createDataFrame([("/d/one/one.h5",), ("/d/one/a.h5",), ("/d/two/c.h5",), ("/d/two/b.h5",), ("/d/two/x.txt",)], "path string")
    assert {r.root: r.name for r in files.master_files(paths).collect()} == {"/d/one": "one.h5", "/d/two": "b.h5"}
    rows = spark.createDataFrame([("/c/x/1.hdf5", 1, True), ("/c/x/2.hdf5", 5, True), ("/c/x/3.hdf5", 9, False)], "path string, mtime int, valid boolean")
    assert files.target(rows, "/c/x").head().path == "/c/x/2.hdf5" and files.target(rows, "/c/x/1.hdf5").head().path == "/c/x/1.hdf5"


def test_files(spark, tmp_path):
    for name in ("col/col_left_0002/reconstructed_volumes/a/v.hdf5", "col/col_left_0002/reconstructed_volumes/v_histogram.hdf5", "col/x/other.hdf5", "col/col_left/reconstructed_volumes/w.hdf5"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"123")
    rows = files.reconstruction_files(files.scan_files(spark, f"file://{tmp_path}")).collect()
    assert sorted((r.collection, r.position, r.seq, r.file_name, r.length) for r in rows) == [("col", "left", 0, "w.hdf5", 3), ("col", "left", 2, "v.hdf5", 3)]
    entries = spark.createDataFrame([("f", "/b", "f", [2, 3, 4]), ("f", "/a", "f", [1, 3, 4]), ("f", "/c", "S", [2, 3, 4]), ("g", "/z", "u", [2, 2])], "file string, name string, kind string, shape array<int>")
    assert [tuple(r) for r in files.candidate_datasets(entries).collect()] == [("f", "/b")]
    assert files.candidate_datasets(entries, True).head().name == "/a"
