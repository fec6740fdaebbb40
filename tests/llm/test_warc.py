import base64
import gzip
import hashlib
import os

from pyspark.sql import functions as F

from voxelweave.llm import common
from voxelweave.llm import warc as W

SCHEMA = "page_id bigint, url string, html string, Digest string, OFFSET int"


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def rows():
    out = [(i, f"http://h/{i}", f"<p>{'page é ' * (i % 7)}{i % 5}</p>", "", 0) for i in range(60)]
    out += [(100, None, None, "", 0), (101, "http://x/\r\nWARC-Type: evil\x7f", "", "", 0), (102, "http://y", "WARC/1.0\r\n\r\n\r\n" * 3, "", 0), (103, "http://z", "z" * 400_000, None, None)]
    return [*out, (None, "http://null", "<p>null</p>", "", 0), (None, "http://null", out[0][2], "", 0), (3, "http://h/3", out[3][2], "", 0)]


def expected(data, least):
    first = {}
    for r in data:
        first.setdefault(r[2] or "", []).append(r[0])
    lows = {t: min((i for i in ids if i is not None), default=None) for t, ids in first.items()}
    taken, out = set(), []
    for page, _, html, *_ in data:
        t = html or ""
        again = len(t.encode()) >= least and (page != lows[t] or t in taken)
        if page == lows[t]:
            taken.add(t)
        out.append((page, len(t.encode()), b32(t), "revisit" if again else "response", lows[t] if again else None))
    return sorted(out, key=str)


def digest(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "digest", "record_type", "refers_to").collect()), key=str)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA)
    for least in (0, 10):
        folder = f"file://{tmp_path}/{least}"
        index = W.write(df, folder, least, file_bytes=2000)
        back = W.read(index, folder)
        assert digest(back) == expected(rows(), least)
        texts = {r.page_id: bytes(r.payload).decode() for r in back.where("record_type = 'response'").collect()}
        assert all(texts[p] in {r[2] or "" for r in rows() if r[0] == p} for p in texts)


def test_hot_payloads_are_written_where_they_lie(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    monkeypatch.setattr(common, "HOT_SHARE", 10**6)
    data = rows() + [(500 + i, f"http://e/{i}", ("", None)[i % 2], "", 0) for i in range(40)] + [(499, None, "", "", 0), (499, "http://e", "", "", 0)]
    folder = f"file://{tmp_path}/hot"
    index = W.write(spark.createDataFrame(data, SCHEMA), folder, file_bytes=2000)
    assert digest(W.read(index, folder)) == expected(data, 0)


def test_record_ids_are_unique(spark, tmp_path):
    for least in (0, 10):
        folder = f"{tmp_path}/{least}"
        W.write(spark.createDataFrame(rows(), SCHEMA), f"file://{folder}", least, file_bytes=2000)
        text = b"".join(gzip.decompress(open(os.path.join(folder, n), "rb").read()) for n in os.listdir(folder) if n.endswith(".gz"))
        ids = [x for x in text.split(b"\r\n") if x.startswith(b"WARC-Record-ID")]
        refers = {x.split(b": ")[1] for x in text.split(b"\r\n") if x.startswith(b"WARC-Refers-To")}
        assert len(ids) == len(set(ids)) == len(rows()) and refers <= {x.split(b": ")[1] for x in ids}


def test_index_ranges_are_whole_records(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    index = W.write(spark.createDataFrame(rows(), SCHEMA), folder).collect()
    by = {}
    for r in index:
        by.setdefault(r.file, []).append(r)
    for name, records in by.items():
        data = open(os.path.join(tmp_path, "w", name), "rb").read()
        end = 0
        for r in sorted(records, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
            raw = gzip.decompress(data[r.offset : end])
            assert raw.startswith(b"WARC/1.0\r\n") and raw.endswith(b"\r\n\r\n") and b"\nWARC-Type: evil" not in raw
        assert end == len(data) and gzip.decompress(data).count(b"WARC-Record-ID") == len(records)


def test_selected_records(spark, tmp_path):
    folder = f"file://{tmp_path}/s"
    index = W.write(spark.createDataFrame(rows(), SCHEMA), folder)
    out = W.read(index.where(F.col("page_id").isin(2, 40, 103)), folder, gap=10, read_bytes=1000)
    assert {r.page_id for r in out.collect()} == {2, 40, 103}


def test_empty(spark, tmp_path):
    folder = f"file://{tmp_path}/e"
    assert W.read(W.write(spark.createDataFrame([], SCHEMA), folder), folder).count() == 0
