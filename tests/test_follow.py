import datetime as dt

from voxelweave.operators import catalog
from voxelweave.streaming import follow

FILES = "collection string, position string, seq int, dataset_name string, file_name string, mtime timestamp_ntz, length bigint, valid boolean"


def row(seq, minute=0, name=None, valid=True, position="p"):
    return ("c", position, seq, f"c_{position}_{seq:04d}", name or f"v{seq}_{minute}.hdf5", dt.datetime(2024, 1, 1, 0, minute), 1, valid)


def drop(spark, path, n, *rows):
    spark.createDataFrame(list(rows), FILES).coalesce(1).write.parquet(f"{path}/in/batch={n}")


def test_only_newer_members_are_emitted(spark, tmp_path):
    root, shown = f"file://{tmp_path}", []
    batches = [(row(1), row(2), row(3)), (row(0), row(2, 9)), (row(5), row(4)), (row(5, 3), row(9, valid=False), row(8, name="x_Histogram.hdf5"))]
    for n, rows in enumerate(batches):
        drop(spark, root, n, *rows)
        stream = spark.readStream.schema(FILES + ", batch int").parquet(f"{root}/in").drop("batch")
        query = follow.follow(stream, f"{root}/history", f"{root}/check", lambda df: shown.extend(r.file_name for r in df.collect()))
        query.awaitTermination(60)
    assert shown == ["v3_0.hdf5", "v5_0.hdf5", "v5_3.hdf5"]
    assert [r.file_name for r in follow.history(spark, f"{root}/history").orderBy("seq", "mtime").collect()] == shown
    numbered = spark.createDataFrame([(n, *r) for n, rows in enumerate(batches) for r in rows], "batch int, " + FILES)
    assert [r.file_name for r in follow.emitted(numbered).orderBy("batch").collect()] == shown


def test_state_follows_over_restarts(spark, tmp_path):
    """Each batch is taken in by a start of its own; the state lives in the checkpoint alone."""
    root, out = f"file://{tmp_path}", []
    batches = [(row(1), row(2), row(3)), (row(0), row(2, 9)), (row(5), row(4), row(7, valid=False), row(2, position="q")), (row(5, 3), row(8, name="x_Histogram.hdf5"), row(1, position="q")), (row(7),)]
    for n, rows in enumerate(batches):
        drop(spark, root, n, *rows)
        stream = spark.readStream.schema(FILES + ", batch int").parquet(f"{root}/in").drop("batch")
        follow.follow_with_state(stream, f"{root}/out", f"{root}/check", reference_seq=1).awaitTermination(60)
        seen = [(r.position, r.file_name) for r in spark.read.parquet(f"{root}/out").collect()]
        out.append(sorted(x for x in seen if x not in sum(out, [])))
    # what could not be read in the third batch is emitted by the last one
    assert out == [[("p", "v3_0.hdf5")], [], [("p", "v5_0.hdf5"), ("q", "v2_0.hdf5")], [("p", "v5_3.hdf5")], [("p", "v7_0.hdf5")]]
    numbered = spark.createDataFrame([(n, *r) for n, rows in enumerate(batches) for r in rows], "batch int, " + FILES)
    want = {(r.position, r.seq, r.mtime, r.file_name) for r in follow.emitted(numbered, 1).collect()}
    assert {(r.position, r.seq, r.mtime, r.file_name) for r in spark.read.parquet(f"{root}/out").collect()} == want


def test_reference_and_exclusion(spark):
    df = spark.createDataFrame([row(1), row(4), row(6, position="q")], FILES)
    assert {r.seq for r in follow.newest(df).collect()} == {4, 6}
    assert {r.seq for r in follow.newest(df, by=["collection"]).collect()} == {6}
    assert {r.seq for r in follow.newest(df, reference_seq=5).collect()} == {6}
    assert {r.seq for r in follow.newest(df, exclude="c_p_0004").collect()} == {1, 6}
    assert [r.seq for r in follow.preload(df.where("position = 'p'"), 4).collect()] == [1, 4]


def test_audit(spark):
    df = spark.createDataFrame([row(1), row(2), row(3), row(5, valid=False)], FILES)
    skipped = spark.createDataFrame([(2,)], "seq int")
    out = {r.seq: r.status for r in catalog.range_audit(df, skipped, 6, 1).collect()}
    assert out == {1: "admitted", 2: "skipped", 3: "admitted", 4: "missing", 5: "unresolved", 6: "missing"}
    pairs = catalog.predecessor_pairs(catalog.admitted(df, skipped))
    assert [(r.seq, r.prev_seq) for r in pairs.collect()] == [(3, 1)]
    assert [(r.seq, r.prev_seq) for r in catalog.preview_pairs(df).collect()] == [(2, 1)]
