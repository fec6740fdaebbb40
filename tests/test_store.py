"""The tile store, runs from a catalog, labels across tiles and the fold by islands."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelweave import schema, storage
from voxelweave.operators import components, diff, events, graph
from voxelweave.plans import queries, tracking
from voxelweave.sources import volumes

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def cells(rng, ny, nx, share, planes=3):
    """Tiles of one whole plane each, with steps of a quarter so that peaks tie."""
    rows = []
    for z in range(planes):
        v = np.where(rng.random((ny, nx)) < share, rng.integers(-4, 5, (ny, nx)) / 4, 0).astype(np.float32)
        rows.append(("s", 1, 0, z, 0, 0, ny, nx, v.ravel().tolist()))
    return rows


DIFF = "series string, seq int, prev_seq int, z int, y0 int, x0 int, ny int, nx int, data array<float>"


def cut(spark, rows, ty, tx):
    """The same planes in tiles of ty by tx."""
    out = []
    for s, seq, prev, z, _, _, ny, nx, data in rows:
        v = np.array(data, np.float32).reshape(ny, nx)
        out += [(s, seq, prev, z, y, x, *v[y : y + ty, x : x + tx].shape, v[y : y + ty, x : x + tx].ravel().tolist()) for y in range(0, ny, ty) for x in range(0, nx, tx)]
    return spark.createDataFrame(out, DIFF).withColumn("threshold", F.lit(0.5))


@pytest.mark.parametrize(("share", "ty", "tx"), [(0.35, 4, 5), (0.6, 3, 3), (0.8, 5, 2), (0.5, 20, 23)])
def test_labels_across_tiles(spark, share, ty, tx):
    rows = cells(np.random.default_rng(int(share * 100)), 20, 23, share)
    tiles = cut(spark, rows, ty, tx)
    want = components.labelled(diff.masked(cut(spark, rows, 20, 23), F.lit(0.5)))
    key = [*components.SLICE, "y", "x", "d", "label"]
    assert sorted(components.tile_labels(tiles).select(key).collect()) == sorted(want.select(key).collect())
    for least in (1, 3):
        got, whole = (df.toPandas().sort_values(["z", "label"]).reset_index(drop=True) for df in (components.tile_regions(tiles, least), components.aggregated(want, least)))
        pd.testing.assert_frame_equal(got[sorted(got)], whole[sorted(whole)], check_dtype=False)


def test_labels_of_a_spiral(spark):
    """One region that winds through all tiles: the graph's roots take several rounds."""
    n = 15
    v, y, x, dy, dx = np.zeros((n, n), np.float32), 0, -1, 0, 1
    length, turn = n, 0
    while length > 0:
        for _ in range(length):
            y, x = y + dy, x + dx
            v[y, x] = 1
        dy, dx = dx, -dy
        turn += 1
        length -= 2 if turn > 1 and turn % 2 == 0 else 0 if turn > 1 else 1
        if turn > 12:
            break
    tiles = cut(spark, [("s", 1, 0, 0, 0, 0, n, n, v.ravel().tolist())], 2, 2)
    want = components.aggregated(components.labelled(diff.masked(cut(spark, [("s", 1, 0, 0, 0, 0, n, n, v.ravel().tolist())], n, n), F.lit(0.5))), 1)
    assert sorted(r.voxel_count for r in components.tile_regions(tiles, 1).collect()) == sorted(r.voxel_count for r in want.collect())


def test_tiles_without_values_and_none(spark):
    rows = [("s", 1, 0, 0, 0, 0, 1, 2, [float("nan"), 1.0]), ("s", 1, 0, 1, 0, 0, 1, 2, [0.0, 0.0]), ("s", 1, 0, 2, 0, 0, 1, 2, None), ("s", 1, 0, 3, 0, 0, 1, 2, [float("-inf"), None])]
    tiles = spark.createDataFrame(rows, DIFF).withColumn("threshold", F.lit(0.5))
    assert sorted((r.z, r.label, r.voxel_count) for r in components.tile_regions(tiles, 1).collect()) == [(0, 1, 1), (3, 0, 1)]
    assert components.tile_regions(tiles.limit(0), 1).count() == 0 == components.tile_labels(tiles.limit(0)).count()


def test_roots(spark):
    rng = random.Random(3)
    links = [(k, a, b) for k in "xy" for a, b in [(i, i + 1) for i in range(40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)]]
    found = {(r.k, r.id): r.root for r in graph.roots(spark.createDataFrame(links, "k string, a bigint, b bigint"), ["k"]).collect()}
    near = {}
    for k, a, b in links:
        if a != b:
            near.setdefault((k, a), set()).add(b)
            near.setdefault((k, b), set()).add(a)
    for node in near:
        seen, todo = {node[1]}, [node[1]]
        while todo:
            for m in near[node[0], todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        assert found[node] == min(seen)
    assert set(found) == set(near)
    assert graph.roots(spark.createDataFrame([], "k string, a bigint, b bigint"), ["k"]).count() == 0


def region(pair, z, label, y, x, n, peak):
    return ("s", pair, 0, z, label, y, y, x, x + 1, n, peak, peak, peak, peak, float(z * n), float(y * n), float(x * n))


COMPONENT = "series string, seq int, prev_seq int, z int, " + schema.COMPONENT.replace("z_weighted_sum double, ", "z_weighted_sum double, ")


@pytest.mark.parametrize("seed", range(4))
def test_islands_give_the_events_of_a_whole_pair(spark, seed):
    rng = random.Random(seed)
    rows = [region(p, z, k, rng.randint(0, 8), 6 * k + rng.randint(0, 3), rng.randint(1, 5), rng.random()) for p in (1, 2) for z in range(40) if rng.random() < 0.7 for k in range(rng.randint(1, 4))]
    table = spark.createDataFrame(rows, COMPONENT)
    names = [c.split()[0] for c in COMPONENT.split(", ")]
    for least in (1, 6):
        got = sorted((r.seq, r.event_id, r.finish_order, r.voxel_count, r.z_min, r.z_max, r.x_min, r.x_max, r.peak_abs_diff) for r in events.assemble(table, least, 2).collect())
        want = []
        for p in (1, 2):
            whole = events.fold(pd.DataFrame([r for r in rows if r[1] == p], columns=names), 2)
            want += [(p, e.number, i, e.voxels, e.box[0], e.box[3], e.box[2], e.box[5], e.peak[0]) for i, e in enumerate(whole) if e.voxels >= least]
        assert got == sorted(want)
    sizes = events.islands(table).groupBy("seq", "island").count().agg(F.max("count")).head()[0]
    assert sizes < table.groupBy("seq").count().agg(F.max("count")).head()[0]


# Store and catalog


@pytest.fixture(scope="module")
def store(spark):
    tiles = volumes.volumes_of_vectors(spark.read.parquet(f"{DATA}/embeddings.parquet"), queries.SERIES)
    return queries._store(spark, DATA, tiles)


def test_differences_over_a_store_need_no_exchange(spark, store):
    text = plan(diff.tile_diffs(store))
    assert "Exchange" not in text and "Bucketed: true" in text
    assert "Exchange" in plan(diff.tile_diffs(spark.read.parquet(f"{DATA}/embeddings.parquet").transform(volumes.tiles_of_vectors)))


def test_only_folders_of_admitted_members_are_read(spark, store):
    files = queries._files(spark, DATA)
    pairs = tracking.pairs_of_catalog(files, store, queries._skipped(spark), 15, 1)
    diffs = tracking.diffs_of_pairs(store, pairs, queries.CROP)
    text = plan(diffs)
    assert "dynamicpruning" in text and "Bucketed: true" in text
    assert "GreaterThanOrEqual(z,1)" in text and "LessThan(z,19)" in text
    there = {(r.series, r.seq, r.prev_seq) for r in diffs.select(*events.PAIR).distinct().collect()}
    assert there == {(r.series, r.seq, r.prev_seq) for r in pairs.collect()} and len(there) > 4
    assert any(p < s - 1 for _, s, p in there)  # a member between them is skipped or has no valid file
    assert (queries.CROP.start, diffs.agg(F.max("z"), F.max("ny"), F.max("nx")).head()[:]) == ((1, 0, 2), (17, 7, 6))


@pytest.mark.parametrize("size", [(8, 8), (3, 5), (2, 2)])
def test_crop_of_tiles(spark, size):
    voxels = volumes.voxels(volumes.tiles_of_vectors(spark.read.parquet(f"{DATA}/embeddings.parquet")).where("seq < 2"))
    tiles = storage.materialize(volumes.tiles(voxels, *size), "tiles")
    for z, y, x in (((2, 5), (1, 7), (3, 8)), (None, (0, 4), None), ((0, 3), None, (7, 8)), ((4, 6), (2, 3), (2, 3))):
        got = volumes.voxels(volumes.crop_tiles(tiles, z, y, x))
        want = queries.slices.crop(voxels, z, y, x)
        for axis, r in (("z", z), ("y", y), ("x", x)):
            want = want.withColumn(axis, F.col(axis) - (r[0] if r else 0))
        assert sorted(got.collect()) == sorted(want.select(got.columns).collect())
    assert volumes.crop_tiles(tiles, (50, 60)).count() == 0


def test_few_and_load(spark, tmp_path):
    assert "BroadcastHashJoin" in plan(spark.range(10).join(storage.few(spark.range(5)), "id"))
    hinted = storage.few(spark.range(5), 4)
    assert "ResolvedHint" not in hinted._jdf.queryExecution().analyzed().toString()
    assert storage.load(spark, f"file://{tmp_path}/none", "a int").count() == 0
