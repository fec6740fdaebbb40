"""Raw volumes: what is read, which array, and which bytes."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelweave.sources import raw, volumes

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('raw')}/vol"
    raw.write(volumes.tiles_of_vectors(spark.read.parquet(f"{DATA}/embeddings.parquet")), path)
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    raw.register(spark)
    yield path
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def load(spark, path, **options):
    reader = spark.read.format("raw_volume").option("path", path)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def test_round_trip(spark, folder):
    tiles = volumes.tiles_of_vectors(spark.read.parquet(f"{DATA}/embeddings.parquet"))
    assert sorted(load(spark, folder).collect()) == sorted(tiles.collect())
    bands = load(spark, folder, lines=3)
    assert bands.agg(F.max("ny"), F.count("*")).head()[:] == (3, 3 * 500)
    assert sorted(volumes.voxels(bands).where("seq = 4 and z = 3").collect()) == sorted(volumes.voxels(tiles).where("seq = 4 and z = 3").collect())


def test_filters_leave_out_files_and_planes(spark, folder):
    some = load(spark, folder, part_bytes=1024).where("seq between 3 and 5 and z >= 2 and z < 10 and y0 = 0")
    assert some.rdd.getNumPartitions() == 3 * 2  # four planes a part
    assert {(r.seq, r.z) for r in some.select("seq", "z").collect()} == {(s, z) for s in (3, 4, 5) for z in range(2, 10)}
    assert load(spark, folder, part_bytes=1024).where("seq in (1, 7) and z = 19").rdd.getNumPartitions() == 2
    assert load(spark, folder).where("seq > 24").count() == 0 and load(spark, folder).where("seq = 3 and seq = 4").count() == 0


def test_pushed_bounds():
    reader = raw.RawReader({"path": ""})
    rest = list(reader.pushFilters([raw.GreaterThan(("z",), 3), raw.LessThanOrEqual(("z",), 8), raw.In(("seq",), (1, 2, 5)), raw.EqualTo(("seq",), 5), raw.EqualTo(("series",), "a"), raw.EqualTo(("z", "a"), 1)]))
    assert [type(f).__name__ for f in rest] == ["EqualTo", "EqualTo"]
    assert [z for z in range(12) if reader._wanted("z", z)] == [4, 5, 6, 7, 8] and [s for s in range(8) if reader._wanted("seq", s)] == [5]


def test_the_first_volume_by_key_is_read(spark, tmp_path):
    a, b = np.arange(24, dtype="<f4"), np.arange(24, dtype="<u2") * 2
    (tmp_path / "m.raw").write_bytes(b"head" + b.tobytes() + a.tobytes())
    arrays = [
        {"key": "/z", "shape": [2, 3, 4], "dtype": "f4", "offset": 4 + 48}, {"key": "/b", "shape": [2, 3, 4], "dtype": "u2", "offset": 4}, {"key": "/a", "shape": [1, 3, 4], "dtype": "f4"},
        {"key": "/0", "shape": [2, 3, 4], "dtype": "S4"}, {"key": "/1", "shape": [24], "dtype": "f4"}, {"key": "/2", "shape": "x", "dtype": "??"}, "no entry",
    ]
    (tmp_path / "m.json").write_text(json.dumps({"file": "m.raw", "series": "s", "seq": 7, "arrays": arrays}))
    raw.register(spark)
    path = f"file://{tmp_path}/m.json"
    assert [x for r in load(spark, path).orderBy("z").collect() for x in r.data] == (2.0 * np.arange(24)).tolist()
    assert [x for r in load(spark, path, key="/z").orderBy("z").collect() for x in r.data] == np.arange(24.0).tolist()
    for key in ("/0", "/none", "/1"):
        with pytest.raises(Exception, match=f"no volume {key}"):
            load(spark, path, key=key).collect()
    with pytest.raises(Exception, match="ends within plane 0"):
        load(spark, path, key="/a").where("z = 0").unionByName(load(spark, path, key="/a")).collect() if (tmp_path / "m.raw").write_bytes(b"12") else None
