import pytest
from pyspark.sql import functions as F

from voxelweave.operators import catalog, projections
from voxelweave.plans import compression, screening
from voxelweave.sources import files, volumes

MEMBER = "collection string, position string, seq int, dataset_name string, file_name string, mtime string"


@pytest.fixture(scope="module")
def members(spark):
    rows = [("c", p, n, f"c_{p}_{n:04d}", f"{p}{n}.h5", f"2024-01-0{n + 1}") for p, n in (("a", 1), ("a", 3), ("b", 2), ("b", 5))]
    return spark.createDataFrame(rows, MEMBER)


def test_numbers_and_picks(spark, members):
    assert {r[:] for r in catalog.numbered(members).select("position", "seq", "frame_index").collect()} == {("a", 1, 1), ("a", 3, 2), ("b", 2, 1), ("b", 5, 2)}
    assert [r.file_name for r in catalog.picked(members, 3).collect()] == ["a3.h5"]
    assert sorted(r.seq for r in catalog.picked(members).collect()) == [1, 2]
    with pytest.raises(ValueError, match="#0007"):
        catalog.picked(members, 7)
    assert catalog.numbered(members.limit(0)).isEmpty()


def test_second_targets(spark, members):
    def found(same):
        return {(r.seq, r.target_seq) for r in catalog.second_targets(members, members, same).collect()}

    assert found(True) == {(1, 3), (3, 3), (2, 5), (5, 5)} and found(False) == {(1, 5), (3, 5), (2, 5), (5, 5)}
    older = members.where("seq < 3")
    assert catalog.second_targets(members.where("seq = 5"), older, False).isEmpty()
    assert spark.range(1).select(catalog.not_older(F.lit(2), F.lit(2))).head()[0] == 2
    with pytest.raises(Exception, match="#0001 is older than reference #0002"):
        spark.range(1).select(catalog.not_older(F.lit(2), F.lit(1))).collect()


def test_readability_is_kept_by_path_time_and_size(spark):
    schema = "path string, mtime int, length int, valid boolean"
    now = spark.createDataFrame([("a", 1, 5, False), ("b", 2, 5, False), ("c", 1, 5, True), ("d", 1, 5, None)], schema)
    known = spark.createDataFrame([("a", 1, 5), ("a", 1, 5), ("b", 1, 5)], "path string, mtime int, length int")
    seen = catalog.with_readability(now, known).orderBy("path").select("known", "readable").collect()
    assert [r[:] for r in seen] == [(True, True), (False, False), (False, True), (False, False)]


def test_only_projections_are_shown(spark):
    scans = spark.createDataFrame([(1, "flat"), (2, "projection")], "scan int, kind string")
    assert projections.required_projection(scans, 2).count() == 1
    with pytest.raises(ValueError, match="1 is a flat scan"):
        projections.required_projection(scans, 1)
    with pytest.raises(ValueError, match="no scan 9"):
        projections.required_projection(scans, 9)


@pytest.mark.parametrize("mode", ["average", "subsample"])
def test_preview_averages_the_slab_in_either_mode(spark, mode):
    data = [(s, [float(s * 100 + i * i) for i in range(20)]) for s in range(5)]
    rows = [("s", 0, z, 0, 0, 4, 5, v) for z, v in data]
    voxels = volumes.voxels(spark.createDataFrame(rows, "series string, seq int, z int, y0 int, x0 int, ny int, nx int, data array<float>"))
    options = compression.Options(factor=2, mode=mode, z=(1, 4))
    got = {r[2:5]: r.v for r in compression.preview_views(voxels, options, (1, 0, 2)).collect()}
    at = {(z, i // 5, i % 5): v[i] for z, v in data for i in range(20) if 1 <= z < 4}

    def mean(keep):
        values = [v for k, v in at.items() if keep(*k)]
        return pytest.approx(sum(values) / len(values))

    def near(i, first):
        return i == first if mode == "subsample" else i in (first, first + 1)

    # the last slab on z and x has one plane
    assert {k[0] for k in got} == {"xy", "xz", "yz"} and len(got) == 2 * 3 + 2 * 3 + 2 * 2
    for r in range(2):
        for c in range(3):
            assert got["xy", r, c] == mean(lambda z, y, x: z == 3 and near(y, 2 * r) and near(x, 2 * c))
            assert got["xz", r, c] == mean(lambda z, y, x: near(z, 1 + 2 * r) and y in (0, 1) and near(x, 2 * c))
        for c in range(2):
            assert got["yz", r, c] == mean(lambda z, y, x: near(z, 1 + 2 * r) and near(y, 2 * c) and x == 4)


def test_directories_and_paths(spark):
    paths = ["/c/a_0001/scan0001/x.h5", "/c/a_0001/a_0001.h5", "/c/b/b.h5", "/c/b/other.h5", "/c/d/reconstructed_volumes/x/v.hdf5", "/c/e/notes.txt", "/c/f/scans.h5", "/c/a_0002/scan1/y.h5", "/c/a_0002/scan2/z.h5"]
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    found = {r.root: r.kinds for r in files.dataset_directories(listed).collect()}
    assert found == {"/c/a_0001": "master,scans", "/c/b": "master", "/c/d": "volumes", "/c/a_0002": "scans"}
    kinds = spark.createDataFrame([("/c/a_0001/scan0001", "projection"), ("/c/a_0002/scan1", "flat")], "scan_path string, kind string")
    got = {r.path: (r.root, r.scan, r.refusal) for r in files.resolved(listed, kinds).collect()}
    assert got == {
        paths[0]: ("/c/a_0001", "scan0001", None), paths[7]: ("/c/a_0002", "scan1", f"{paths[7]} is a flat scan; only projections can be shown"),
        paths[8]: ("/c/a_0002", "scan2", f"{paths[8]} is a unknown scan; only projections can be shown"),
    }
    scans = [("/c/a_0001", "scan1", "flat", 9), ("/c/a_0001", "scan2", "projection", 5), ("/c/a_0001", "scan3", "projection", 50), ("/c/a_0003", "scan1", "projection", 6), ("/c/a", "scan1", "projection", 7)]
    table = spark.createDataFrame(scans, "root string, scan string, kind string, frames bigint")

    def listed_by(*args, **more):
        return [(r.root, r.seq, r.scan) for r in files.projection_datasets(table, *args, **more).collect()]

    assert listed_by(4) == [("/c/a", 0, "scan1"), ("/c/a_0001", 1, "scan2"), ("/c/a_0003", 3, "scan1")]
    assert listed_by(5) == [("/c/a", 0, "scan1"), ("/c/a_0003", 3, "scan1")]
    assert listed_by(0, least=1, exclude="/c/a_0003") == [("/c/a_0001", 1, "scan2")]


def test_raw_screening():
    assert screening.raw_only(True, "raw") and not screening.raw_only(True, "pair") and not screening.raw_only(False, "raw")
