"""WARC archives, index first: write records with an index, then read selected byte ranges.

Writing finds the first page of each payload digest from narrow columns (page, url, digest). Pages with
a digest that very many share are written from where they lie; the others are dealt by digest. Each
task writes archives of bounded size into the shared folder, a gzip member per record, and returns an
index row per record (file, offset, length, url, digest). Archives are named after the task attempt
and only the index of the attempt that succeeded refers to them, so a lost executor or a repeated
task does no harm. Reading takes any selection of the index, sorts it by file and offset, and joins
neighbouring records into one read; its tasks are as many as the bytes to read ask for.

Of records with equal payloads of at least ``min_revisit`` bytes, the one with the smallest page id
is the response and the others revisit it.

Defined results: a null html is an empty payload, a payload may have any length that a task can hold;
null page ids come last in that order; of rows that share page id and payload the one with the first
url (null last) is the response, of rows equal in all three any one; a null url leaves the header
out; control characters in a url are percent-encoded; other columns, whatever their names, are
ignored; an empty table writes no archive.
"""

from __future__ import annotations

import base64
import gzip
import posixpath
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

MIN_REVISIT = 0
FILE_BYTES = 128 << 20
#: Reads join records this near to each other, up to so many bytes at once.
GAP, READ_BYTES = 64 << 10, 8 << 20
#: Bytes of archives for a task that reads.
TASK_BYTES = 64 << 20
#: The table has no crawl time.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
INDEX = "page_id bigint, url string, digest string, record_type string, file string, offset bigint, length bigint"
RECORDS = "page_id bigint, url string, record_type string, digest string, payload_bytes bigint, refers_to bigint, payload binary"


def _urn(page_id: int | None, name: str) -> str:
    return f"<urn:voxelweave:page:{'' if page_id is None else page_id}:{name}>"


def _page(urn: str) -> int | None:
    found = urn.strip("<>").split(":")[3]
    return int(found) if found else None


def record(page_id: int | None, name: str, url: str | None, payload: bytes, digest: str, first: tuple | None) -> bytes:
    """One WARC record; first: page id and name of the response that this one revisits."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first else http + payload
    head = [("WARC-Type", "revisit" if first else "response"), ("WARC-Record-ID", _urn(page_id, name)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if ord(c) >= 32 and ord(c) != 127 else f"%{ord(c):02X}" for c in url)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if first:
        head += [("WARC-Refers-To", _urn(*first)), ("WARC-Profile", PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of RECORDS from a record's bytes; a revisit has its payload's size and digest, not the payload."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    again = fields["WARC-Type"] == "revisit"
    if not again and (len(payload) != size or _digest(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not the one that was written")
    return {"page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "digest": digest, "payload_bytes": size, "refers_to": _page(fields["WARC-Refers-To"]) if again else None, "payload": None if again else payload}


def _digest(payload: bytes) -> str:
    import hashlib

    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _order() -> Column:
    """Of pages with one payload the least is the response."""
    return F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url")


def _with_first(rows: DataFrame) -> DataFrame:
    """rows (page_id, url, payload, sha1) with first_page, and whether a row comes after the first of its payload."""
    order = _order()
    heads = rows.groupBy("sha1").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    heads = common.materialize(heads.where("n > 1"), "first-pages")
    total = heads.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    hot = heads.where(F.col("n") >= max(common.HOT_ROWS, total // common.HOT_SHARE))  # at most HOT_SHARE rows
    window = Window.partitionBy("sha1").orderBy(F.col("page_id").asc_nulls_last(), F.col("url").asc_nulls_last())
    if hot.isEmpty():
        there, dealt = None, rows
    else:
        known = rows.join(F.broadcast(hot.select("sha1", "first")), "sha1", "left")
        # the first itself, and rows equal to it, are dealt as well: only one of them is the response
        after = F.col("first").isNotNull() & (order != F.col("first"))
        there = known.where(after).select("page_id", "url", "payload", "sha1", F.lit(True).alias("again"), F.col("first.page_id").alias("first_page"))
        dealt = known.where(~after).drop("first")
    dealt = dealt.select("page_id", "url", "payload", "sha1", (F.row_number().over(window) > 1).alias("again"), F.first("page_id").over(window).alias("first_page"))
    return dealt if there is None else dealt.unionByName(there)


def write(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives into folder; the index, kept in the shared folder as well."""
    rows = common.only(pages, "page_id", "url", "html")
    rows = rows.select(F.col("page_id").cast("bigint"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    found = _with_first(rows.withColumn("sha1", F.sha1("payload")))
    again = F.col("again") & (F.octet_length("payload") >= min_revisit)
    joined = found.select("page_id", "url", "payload", "sha1", again.alias("again"), "first_page")

    def run(batches: Iterator[pa.RecordBatch]):
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        task, out, made, at = TaskContext.get(), None, 0, 0
        try:
            for batch in batches:
                index = []
                for r in batch.to_pylist():
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.warc.gz"
                        out, made, at = fs.open_output_stream(posixpath.join(base, name), compression=None), made + 1, 0
                    digest = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                    # only a response that may be referred to is named by its digest, which no other one has
                    lone = not r["again"] and len(r["payload"]) >= min_revisit
                    place = f"{task.partitionId()}.{task.taskAttemptId()}.{made}.{at}"
                    first = (r["first_page"], digest) if r["again"] else None
                    member = gzip.compress(record(r["page_id"], digest if lone else place, r["url"], r["payload"], digest, first), 4, mtime=0)
                    out.write(member)
                    index.append({"page_id": r["page_id"], "url": r["url"], "digest": digest, "record_type": "revisit" if first else "response", "file": name, "offset": at, "length": len(member)})
                    at += len(member)
                yield pa.RecordBatch.from_pylist(index, pa.schema([(c.split()[0], pa.string() if c.split()[1] == "string" else pa.int64()) for c in INDEX.split(", ")]))
        finally:
            if out is not None:
                out.close()

    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    return common.materialize(joined.mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame, folder: str, gap: int = GAP, read_bytes: int = READ_BYTES) -> DataFrame:
    """RECORDS of the index's rows, by joined byte ranges."""
    dealt = index.select("file", "offset", "length", F.floor(F.col("offset") / read_bytes).alias("part"))
    size = index.agg(F.sum("length")).head()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    dealt = dealt.repartition(tasks, "file", "part").sortWithinPartitions("file", "offset").drop("part")
    schema = pa.schema([(c.split()[0], {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in RECORDS.split(", ")])

    def ranges(rows):
        some, end = [], 0
        for name, at, n in rows:
            if some and (name != some[0][0] or at > end + gap or at + n - some[0][1] > read_bytes):
                yield some
                some = []
            some.append((name, at, n))
            end = at + n
        if some:
            yield some

    def run(batches: Iterator[pa.RecordBatch]):
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for some in ranges(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)):
                name, start, _ = some[0]
                with fs.open_input_file(posixpath.join(base, name)) as f:
                    data = f.read_at(some[-1][1] + some[-1][2] - start, start)
                found = [parse(gzip.decompress(data[at - start : at - start + n])) for _, at, n in some]
                yield pa.RecordBatch.from_pylist(found, schema)

    return dealt.mapInArrow(run, RECORDS)
