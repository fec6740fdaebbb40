"""The jobs: whole results against SQL, growing input, and starting again after a break."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import portal_index, queries, track_series
from voxelweave import runs, storage
from voxelweave.operators import catalog

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, name, sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in ("events", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/{sf}/{t}.parquet'")
    got = queries.QUERIES[name](spark, f"/root/testdata/{sf}")
    want = con.execute(queries.ORACLE[name])
    at = [d[0] for d in want.description]
    assert sorted(at) == sorted(got.columns)

    def plain(v):
        return round(v, 3) + 0.0 if isinstance(v, float) else v

    there = sorted((tuple(plain(r[at.index(c)]) for c in sorted(at)) for r in want.fetchall()), key=repr)
    here = sorted((tuple(map(plain, r)) for r in rows(got)), key=repr)
    assert here == there and len(here) >= 50


# Tracking


@pytest.fixture(scope="module")
def config():
    return json.loads(track_series.CONFIG.read_text())


@pytest.fixture(scope="module")
def whole(spark, config, tmp_path_factory):
    out = f"file://{tmp_path_factory.mktemp('whole')}/out"
    track_series.run(spark, f"{DATA}/embeddings.parquet", f"{DATA}/events.parquet", out, config)
    return out


def copied(spark, path, where):
    """A copy of the vectors, some of them."""
    spark.read.parquet(f"{DATA}/embeddings.parquet").where(where).write.mode("overwrite").parquet(path)
    return path


def test_growing_input_gives_the_same_tables(spark, config, whole, tmp_path, caplog):
    caplog.set_level("INFO")
    out, vectors = f"file://{tmp_path}/out", f"file://{tmp_path}/vectors"
    sizes = []
    # the second input ends within a volume: that member waits, and so do those of other series only if they are incomplete
    for where in ("vec_id < 200", "vec_id < 350", "true", "true"):
        track_series.run(spark, copied(spark, vectors, where), f"{DATA}/events.parquet", out, config)
        sizes.append(runs.load(spark, out, "comparisons").count())
    assert 0 < sizes[0] < sizes[1] < sizes[2] == sizes[3] == runs.load(spark, whole, "comparisons").count()
    assert "nothing new" in caplog.text and "new pairs" in caplog.text
    assert rows(track_series.output(spark, out)) == rows(track_series.output(spark, whole))


def test_only_new_members_are_compared(spark, config, tmp_path, monkeypatch):
    out, vectors = f"file://{tmp_path}/out", f"file://{tmp_path}/vectors"
    track_series.run(spark, copied(spark, vectors, "vec_id < 300"), f"{DATA}/events.parquet", out, config)
    taken = []
    real = track_series.tracking.diffs_of_pairs
    monkeypatch.setattr(track_series.tracking, "diffs_of_pairs", lambda t, p, c: taken.extend(p.collect()) or real(t, p, c))
    before = {r.series: r.done for r in track_series.marks(spark, out).collect()}
    track_series.run(spark, copied(spark, vectors, "true"), f"{DATA}/events.parquet", out, config)
    assert taken and all(r.seq > before[r.series] for r in taken)


def test_a_run_that_broke_off_is_made_up_for(spark, config, whole, tmp_path, monkeypatch):
    out, args = f"file://{tmp_path}/out", (f"{DATA}/embeddings.parquet", f"{DATA}/events.parquet")
    real = runs.save

    def breaks(df, root, table):
        real(df, root, table)
        if table == "events":
            raise RuntimeError("lost")

    monkeypatch.setattr(runs, "save", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        track_series.run(spark, *args, out, config)
    monkeypatch.setattr(runs, "save", real)
    assert track_series.marks(spark, out).isEmpty() and not runs.load(spark, out, "events").isEmpty()
    track_series.run(spark, *args, out, config)
    assert rows(track_series.output(spark, out)) == rows(track_series.output(spark, whole))


def test_tables_are_typed_and_their_keys_hold(spark, whole):
    tables = {t: runs.load(spark, whole, t) for t in runs.TABLES}
    assert runs.orphans(*tables.values()).isEmpty()
    types = dict(tables["runs"].dtypes)
    assert (types["merge_gap"], types["baseline_sigma"], types["created_at"]) == ("int", "double", "timestamp")
    run = tables["runs"].where("run_id = 'c0_click'").head()
    assert (run.crop_z_start, run.crop_y_start, run.crop_x_start, run.skipped_scans) == (2, 1, 0, "3")
    for table in ("comparisons", "events"):
        assert tables[table].groupBy("id").count().where("count > 1").isEmpty()
    lost = runs.orphans(tables["runs"].where("run_id <> 'c1_click'"), tables["comparisons"].where("sequence_number % 2 = 0"), tables["events"])
    assert {r.table for r in lost.collect()} == {"comparisons", "events"}
    assert lost.where("table = 'events'").count() == tables["events"].where("sequence_number % 2 = 1").count()
    with pytest.raises(ValueError, match="no columns extra"):
        runs.save(spark.range(1).select(F.lit(1).alias("extra")), whole, "runs")


def test_export_has_the_columns_in_order(spark, whole, tmp_path):
    found = runs.export(runs.load(spark, whole, "comparisons"), runs.load(spark, whole, "events"))
    assert found.columns == runs.EXPORT and len(runs.EXPORT) == 32
    order = [(r.dataset_root.rsplit("_", 1)[0], r.sequence_number, r.event_rank) for r in found.collect()]
    assert order == sorted(order) and found.count() == runs.load(spark, whole, "events").count()
    first = found.head()
    assert (first.full_z_min, first.full_y_min, first.full_x_min) == (first.z_min + 2, first.y_min + 1, first.x_min)


# Portal


def test_pages_are_taken_once(spark, tmp_path, caplog):
    caplog.set_level("INFO")
    config, out, pages = {"positions": ["en", "de"], "files_per_batch": 1}, f"file://{tmp_path}/out", f"file://{tmp_path}/pages"
    data = spark.read.parquet(f"{DATA}/pages.parquet")

    def taken():
        return spark.read.parquet(f"{out}/entries").groupBy("batch").count().count()

    data.where("page_id % 3 = 0").coalesce(1).write.mode("append").parquet(pages)
    portal_index.run(spark, pages, out, config)
    assert taken() == 1
    data.where("page_id % 3 = 1").repartition(2).write.mode("append").parquet(pages)
    data.where("page_id % 3 = 2").coalesce(1).write.mode("append").parquet(pages)
    portal_index.run(spark, pages, out, config)
    assert taken() == 4
    portal_index.run(spark, pages, out, config)
    assert taken() == 4
    once = f"file://{tmp_path}/once"
    portal_index.run(spark, f"{DATA}/{{pages.parquet}}", once, config)
    assert rows(portal_index.output(spark, out)) == rows(portal_index.output(spark, once))


def test_a_batch_that_broke_off_is_written_again(spark, tmp_path, monkeypatch):
    config, out = {"positions": ["en"], "files_per_batch": 8}, f"file://{tmp_path}/out"
    real = storage.replace

    def breaks(df, path, by):
        real(df, path, by)
        if path.endswith("/entries"):
            raise RuntimeError("lost")

    monkeypatch.setattr(storage, "replace", breaks)
    with pytest.raises(Exception, match="lost"):
        portal_index.run(spark, f"{DATA}/{{pages.parquet}}", out, config)
    monkeypatch.setattr(storage, "replace", real)
    portal_index.run(spark, f"{DATA}/{{pages.parquet}}", out, config)
    assert spark.read.parquet(f"{out}/entries").count() == spark.read.parquet(f"{DATA}/pages.parquet").count()


def test_odd_pages_and_none(spark, tmp_path):
    config, out = {"positions": ["en"], "files_per_batch": 8}, f"file://{tmp_path}/out"
    odd = [(1, None, None), (None, "http://A.b/en/7.html?x#y", "<TITLE>t</title>"), (3, "no scheme/en/7", ""), (4, "http://a.b/en/x7", "é"), (5, "http://a.b/it/12345/", None), (6, "http://a.b/en/7", "<title></title>"), (6, "http://a.b/en/7", "<title></title>"), (7, "http://a.b/en/99999999999", "")]
    spark.createDataFrame(odd, portal_index.portal.PAGES).coalesce(1).write.parquet(f"file://{tmp_path}/odd")
    portal_index.run(spark, f"file://{tmp_path}/odd", out, config)
    got = sorted(((r.page_id, r.collection, r.position, r.seq, r.dataset_name, r.title, r.length, r.section, r.entries, r.newest_page) for r in portal_index.output(spark, out).collect()), key=repr)
    assert got == sorted([
        (1, None, None, None, None, None, 0, "other", None, None), (None, "a.b", "en", 7, "a.b_en_0007", "t", 16, "en", 3, 6), (3, None, None, None, None, None, 0, "other", None, None),
        (4, "a.b", None, None, None, None, 2, "other", None, None), (5, "a.b", "it", 12345, "a.b_it_12345", None, 0, "other", 1, 5), (6, "a.b", "en", 7, "a.b_en_0007", None, 15, "en", 3, 6),
        (6, "a.b", "en", 7, "a.b_en_0007", None, 15, "en", 3, 6), (7, "a.b", None, None, None, None, 0, "other", None, None),
    ], key=repr)
    spark.createDataFrame([], portal_index.portal.PAGES).coalesce(1).write.parquet(f"file://{tmp_path}/none")
    portal_index.run(spark, f"file://{tmp_path}/none", f"{out}2", config)
    assert portal_index.output(spark, f"{out}2").count() == 0


def test_nothing_but_core_is_imported():
    for module in (track_series, portal_index, queries):
        text = open(module.__file__).read()
        assert "llm" not in text and "corpus_pipeline" not in text
    assert catalog.SERIES == portal_index.SERIES
