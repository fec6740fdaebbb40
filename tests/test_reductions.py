"""Selection by counting, kernels on tiles, and rules of frames, settings and ranges by hand."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelweave.operators import catalog, diff, frames, kernels, projections, selection, transform
from voxelweave.plans import stages, tracking
from voxelweave.sources import volumes

TILE = "series string, seq int, z int, y0 int, x0 int, ny int, nx int, data array<float>"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def cube():
    return np.random.default_rng(2).normal(size=(9, 10, 7)).astype(np.float32)


def tiled(spark, cube, ty, tx, series="s"):
    rows = [(series, 0, z, y, x, *p[y : y + ty, x : x + tx].shape, p[y : y + ty, x : x + tx].ravel().tolist()) for z, p in enumerate(cube) for y in range(0, cube.shape[1], ty) for x in range(0, cube.shape[2], tx)]
    return spark.createDataFrame(rows, TILE)


def as_dict(df, *axes):
    return {tuple(r[a] for a in axes): r.v for r in df.collect()}


@pytest.mark.parametrize("size", [(10, 7), (4, 3), (1, 1)])
@pytest.mark.parametrize(("factors", "start"), [((3, 3, 3), (0, 0, 0)), ((2, 4, 1), (0, 0, 0)), ((1, 3, 5), (0, 0, 0)), ((9, 10, 7), (0, 0, 0))])
def test_block_means(spark, cube, size, factors, start):
    got = as_dict(kernels.block_means(tiled(spark, cube, *size), factors, start), "z", "y", "x")
    want = {}
    for at in np.ndindex(cube.shape):
        want.setdefault(tuple(int(a) // f for a, f in zip(at, factors)), []).append(float(cube[at]))
    assert got == {k: pytest.approx(sum(v) / len(v)) for k, v in want.items()}


def test_no_voxel_becomes_a_row_below_the_sums(spark, cube, monkeypatch):
    tiles = tiled(spark, cube, 10, 7)
    text = plan(kernels.block_means(tiles, (3, 3, 3)))
    assert text.index("Generate") < text.index("Aggregate") < text.index("MapInArrow") and "Generate" not in text[text.index("Aggregate") :]
    monkeypatch.setattr(kernels, "PLANES", 2)  # several steps
    assert as_dict(kernels.slab_means(tiles, "z", 1, 8), "y", "x") == {(y, x): pytest.approx(float(cube[1:8, y, x].astype(float).mean())) for y in range(10) for x in range(7)}
    assert as_dict(kernels.block_means(tiles, (8, 10, 7)), "z", "y", "x")[0, 0, 0] == pytest.approx(float(cube[:8].astype(float).mean()))


@pytest.mark.parametrize("size", [(10, 7), (4, 3)])
def test_slabs_and_subsamples(spark, cube, size):
    tiles = tiled(spark, cube, *size)
    assert as_dict(kernels.slab_means(tiles, "y", 2, 9), "z", "x") == {(z, x): pytest.approx(float(cube[z, 2:9, x].astype(float).mean())) for z in range(9) for x in range(7)}
    for start in ((0, 0, 0), (1, 1, 2)):
        cropped = tiles.where(f"z >= {start[0]}")
        got = as_dict(kernels.subsampled(cropped, 3, start), "z", "y", "x")
        want = {(k, j, i): float(cube[z, y, x]) for k, z in enumerate(range(start[0], 9, 3)) for j, y in enumerate(range(start[1], 10, 3)) for i, x in enumerate(range(start[2], 7, 3))}
        assert {k: v for k, v in got.items() if min(k) >= 0} == want
    assert kernels.block_means(tiles.limit(0), (2, 2, 2)).count() == 0


# Selection


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_order_statistics(spark, bins):
    rng = np.random.default_rng(bins)
    groups = {
        "normal": rng.normal(size=501), "ties": rng.integers(0, 4, 300).astype(float), "one": np.array([3.5]), "equal": np.full(50, -2.0), "skewed": np.exp(rng.normal(size=400) * 12),
        "tiny": np.array([0.0, 5e-324, 1e-310, 1.0]), "ends": np.array([-math.inf, -1.0, 0.0, 2.0, math.inf, math.inf]),
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("normal", math.nan), ("normal", None), ("empty", None)]
    values = spark.createDataFrame(rows, "k string, v double")
    wanted = [(k, r) for k, vs in groups.items() for r in {0, 1, len(vs) // 3, len(vs) // 2, len(vs) - 1, len(vs)}] + [("empty", 0), ("unknown", 0), ("one", -1)]
    got = {(r.k, r["rank"]): r.v for r in selection.order_statistics(values, ["k"], spark.createDataFrame(wanted, "k string, rank bigint"), bins).collect()}
    assert got == {(k, r): sorted(vs)[r] for k, vs in groups.items() for kk, r in wanted if kk == k and 0 <= r < len(vs)}


def test_percentiles_and_noise(spark):
    rng = np.random.default_rng(1)
    rows = [("a", float(v)) for v in rng.normal(size=333)] + [("b", 0.0)] * 9 + [("b", 10.0)]
    values = spark.createDataFrame(rows, "k string, v double")
    shares = [0.001, 0.05, 0.5, 0.5, 0.995, 1.0]
    for r in selection.percentiles(values, ["k"], shares, 16).collect():
        v = [x for k, x in rows if k == r.k]
        assert r.n == len(v) and r.p == pytest.approx(np.percentile(v, [100 * s for s in shares]).tolist())
    plain = {r.k: r.sigma for r in diff.robust_sigma(values, ["k"], "v").collect()}
    assert {r.k: r.sigma for r in selection.robust_sigma(values, ["k"], 16).collect()} == {k: pytest.approx(s) for k, s in plain.items()}
    assert selection.percentiles(values.limit(0), ["k"], [0.5]).count() == 0


# Rules by hand


def test_saved_frames(spark):
    inf, nan = math.inf, math.nan
    planes = {1: [5.0, 5.0, 5.0, 5.0], 2: [nan, inf, -inf, nan], 3: [nan, 4.0, 4.0, 4.0], 4: [0.0] * 400 + [8.0]}
    rows = spark.createDataFrame([(k, 0, i, v) for k, vs in planes.items() for i, v in enumerate(vs)], "k int, y int, x int, v float")
    got = {}
    for r in frames.normalised_frames(rows, ["k"]).orderBy("k", "x").collect():
        got.setdefault(r.k, []).append(r.v)
    assert got[1] == [0.0] * 4 and got[2] == [0.0] * 4  # one value, and none at all: black
    assert got[3] == [0.0, 1.0, 1.0, 1.0]  # no number counts as 0: the range is 0.12 to 4
    assert got[4] == [0.0] * 400 + [1.0]  # equal percentiles: least and greatest value
    fixed = frames.normalised_frames(rows.where("k = 1"), ["k"], low=5.0, high=5.0)
    assert {r.v for r in fixed.collect()} == {0.0}


def test_suggested_factor_and_sizes(spark):
    stats = spark.createDataFrame([("s", 0, -1.0, 2.0, 0.5)], "series string, seq int, p0_5 double, p99_5 double, sigma double")
    shapes = spark.createDataFrame([("s", 0, 2000, 1500, 1000)], "series string, seq int, nz int, ny int, nx int")

    def found(**options):
        r = transform.suggestions(stats, shapes, **options).head()
        return (r.clip_min, r.clip_max, r.mask_below, r.downsample, r["size"], r.uint8_size, r.size_by_2, r.size_by_4)

    # 3e9 voxels are 2.79 times 1024 cubed, of which the cube root is 1.41: two at least
    assert found() == (-1.0, 2.0, 1.5, 2, "11.2 GB", "2.8 GB", "1.4 GB", "178.8 MB")
    assert found(factor=2)[3] == 2 and found(factor=4)[3] == 4 and found(most=10**6)[3] == 15
    assert found(factor=3, most=10**6)[3] == 5  # 667 * 500 * 334


def test_one_sided_bounds(spark):
    members = spark.createDataFrame([("c", p, n) for p, ns in (("a", range(11)), ("b", (3, 30))) for n in ns], "collection string, position string, seq int")

    def kept(start, stop):
        return sorted((r.position, r.seq) for r in catalog.within_series(members, start, stop).collect())

    assert kept(20, None) == [("a", 10), ("b", 30)]  # for a, 10 to 20 after the swap
    assert kept(8, None) == [("a", 8), ("a", 9), ("a", 10), ("b", 30)]
    assert kept(None, 2) == [("a", 0), ("a", 1), ("a", 2), ("b", 3)]
    assert kept(9, 4) == [("a", n) for n in range(4, 10)] and len(kept(None, None)) == 13


def test_a_number_twice_is_refused(spark):
    members = spark.createDataFrame([("c", "a", 1, "x"), ("c", "a", 2, "y"), ("c", "b", 1, "z")], "collection string, position string, seq int, dataset_name string")
    assert catalog.single(members).count() == 3
    with pytest.raises(Exception, match="c_a has more than one member #0002"):
        catalog.single(members.union(spark.createDataFrame([("c", "a", 2, "w")], members.schema))).collect()


def test_the_first_key_that_is_there(spark):
    blocks = spark.createDataFrame([(1, 1, 5, None), (1, 2, 5, 0), (1, 3, 5, 2), (2, 1, 3, None)], "scan int, block int, frame_count int, image_key int")
    assert {r.scan: (r.kind, r.frames) for r in projections.frame_counts(blocks).collect()} == {1: ("projection", 15), 2: ("unknown", 3)}


def test_noise_that_is_no_number_is_refused(spark, cube):
    tiles = tiled(spark, cube, 10, 7).union(tiled(spark, cube + np.random.default_rng(3).normal(size=cube.shape).astype(np.float32), 10, 7).withColumn("seq", F.lit(1)))
    assert tracking.thresholds(diff.tile_diffs(tiles), tracking.SMALL).head().threshold > 0
    broken = tiles.withColumn("data", F.when(F.col("z") == 4, F.transform("data", lambda v, i: F.when(i == 3, F.lit(math.nan)).otherwise(v).cast("float"))).otherwise(F.col("data")))
    with pytest.raises(Exception, match="no noise to measure"):
        tracking.thresholds(diff.tile_diffs(broken), tracking.SMALL).collect()


def test_preview_slice_looks_at_the_last_plane(spark):
    z = np.zeros((9, 4, 6), np.float32)
    z[8, 2, 2], z[4, 2, 4], z[5, 0, 0], z[4, 1, 1] = 3, 2, 9, 8  # the two largest lie beside the grid
    tiles = tiled(spark, np.zeros_like(z), 4, 6).union(tiled(spark, z, 4, 6).withColumn("seq", F.lit(1)))
    best = diff.preview_slice(diff.tile_diffs(tiles), planes=2, lines=2).head()
    assert (best.z, best.max_abs_diff) == (8, 3.0)
    assert diff.preview_slice(diff.tile_diffs(tiles)).head().z == 5
    assert volumes.shapes(tiles).count() == 2


def test_stages_of_a_pair(spark, cube):
    tiles = tiled(spark, cube, 4, 3).union(tiled(spark, cube[::-1] * 2, 4, 3).withColumn("seq", F.lit(4)))
    found = {s.name: s for s in stages.of_pair(tiles, "s", 4, 0, tracking.SMALL, tracking.Crop(z=(1, 8), y=(2, 10)))}
    part = cube[::-1][1:8, 2:].astype(np.float32) * 2 - cube[1:8, 2:]
    assert (found["shape"].rows, found["shape"].value) == (2 * part.size, 7.0) and found["slice_pair"].rows == 2 * part[0].size
    assert [found[f"diff_slice_{z}"].value for z in (2, 3, 4)] == [pytest.approx(float(np.abs(part[z]).max())) for z in (2, 3, 4)]
    mid = np.median(part.astype(float))
    sigma = np.median(np.abs(part - mid)) / diff.NORMAL_QUARTILE
    assert found["noise"].value == pytest.approx(2 * sigma) and all(s.seconds >= 0 for s in found.values())
    best = int(np.abs(part).max((1, 2)).argmax())
    near = np.abs(part[max(0, best - 2) : best + 3])
    assert found["preview_slice"].value == best and found["window"].rows == (near >= np.float32(2 * sigma)).sum()
    with pytest.raises(ValueError, match="no tiles of s #0009"):
        stages.of_pair(tiles, "s", 9, 8)


def test_colour_maps(spark):
    assert frames.colour_table("gray")[0] == (0, 0, 0, 0) and frames.colour_table("gray")[255] == (255, 255, 255, 255)
    hot = frames.colour_table("hot")
    # red starts at 0.0416 of 255, is full from 0.365 on; green rises between 0.365 and 0.746; blue after that
    assert hot[0] == (0, 10, 0, 0) and hot[93][1] == 254 and hot[94] == (94, 255, 2, 0) and hot[191] == (191, 255, 255, 2) and hot[255] == (255, 255, 255, 255)
    assert frames.colour_table("cool")[0] == (0, 0, 255, 255)
    with pytest.raises(ValueError, match="no such colour map: plaid"):
        frames.colour_table("plaid")
    rows = spark.createDataFrame([(0, 0, 0, 0.0), (0, 0, 1, 0.5), (0, 0, 2, 0.999), (0, 0, 3, 1.0)], "k int, y int, x int, v double")
    got = {r.x: tuple(r.rgb) for r in frames.coloured(rows, ["k"], "hot").collect()}
    assert got == {0: hot[0][1:], 1: hot[128][1:], 2: hot[255][1:], 3: hot[255][1:]}
