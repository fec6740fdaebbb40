"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

Every byte under a ``length``-byte string that starts anywhere else too is removed; strings are
judged on the input. A suffix array of all bytes would need over ten times the input in shuffles,
so suffixes are first dealt by content, without losing a pair: each ``length``-byte window is filed
under the smallest hash among its ``GRAM``-byte substrings, so equal windows are filed together.
Consecutive windows with one smallest place form a chunk, which moves as a few numbers.

* A file with one chunk has no repeats and is done; of equal chunks all bytes are repeats. Both are
  settled from counts.
* Where a file has different chunks, one copy of each chunk's bytes is fetched, and blocks of whole
  files are sorted by the difference-cover algorithm of ``suffix_sort``: sampled triples are
  sorted and named, the names are sorted by recursion, the remaining suffixes are merged, and
  neighbours in the order are compared on their ``length``-byte prefixes.
* A file of more than ``FILE_CHUNKS`` different chunks (a passage that very many documents share,
  each time between other texts) is filed again before that: its windows are parted by where in them
  the smallest gram lies, in ever narrower ranges (``WIDTHS``), and filed under the bytes that all
  windows of a range share, a string that grows up to the whole window. So files get small enough for
  a block, whatever a corpus repeats.

Defined results: null text is empty; texts below ``length`` bytes keep everything; documents that
share an id are told apart by 128 bits of id and text; equal rows are each other's repeats; whole
texts count, however long; an empty table gives no rows; other columns, whatever their names, are
ignored by ``repeats`` and kept by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .minhash import mix, powers
from .suffix_sort import repeated_starts

LENGTH = 200
GRAM = 64
BLOCK_BYTES = 1 << 19
FILE_CHUNKS = 2500
#: Places of the smallest gram within a window that are filed together, each time that a file is too large.
WIDTHS = (35, 9, 3, 1)
#: Windows hashed at once, so that a place fits 16 bits.
_SLICE = 60_000
#: content and content2 are one 128-bit hash: where they are equal, chunks count as equal.
CONTENT = ["content", "content2"]
CHUNKS = "doc bigint, mark bigint, file bigint, content bigint, content2 bigint, start int, size int"


def _grams(d: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each gram-byte string of at most _SLICE, ordered by its upper bits, then by place."""
    up, down = powers(len(d) + 1)
    sums = np.zeros(len(d) + 1, np.uint64)
    np.cumsum((d.astype(np.uint64) + np.uint64(1)) * up[1:], out=sums[1:])
    h = mix((sums[gram:] - sums[:-gram]) * down[: len(d) - gram + 1])
    return (h & ~np.uint64(0xFFFF)) | np.arange(len(h), dtype=np.uint64)


def chunks(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(file, start, size in bytes) of the chunks of a text: runs of windows with one smallest gram."""
    found = []
    for base in range(0, len(data) - length + 1, _SLICE):
        h = _grams(np.frombuffer(data, np.uint8)[base : base + _SLICE + length - 1], gram)
        w, m = length - gram + 1, len(h)
        rows = np.concatenate((h, np.full(-m % w, 2**64 - 1, np.uint64))).reshape(-1, w)
        left = np.minimum.accumulate(rows, axis=1).ravel()
        right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(right[: m - w + 1], left[w - 1 : m])
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        start, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(least)]))
        found.append(((least[start] >> np.uint64(16)).view(np.int64), base + start, end - start + length - 1))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def parted(data: bytes, width: int, length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(file, start, size) of the pieces of a chunk: its windows by the place of the smallest gram in them, width places a piece.

    A piece is filed under its range and the bytes that every window of the range has.
    """
    place = int(_grams(np.frombuffer(data, np.uint8), gram).argmin())
    out, at, windows = [], 0, len(data) - length + 1
    while at < windows:
        k = (place - at) // width  # the smallest gram lies k * width to (k + 1) * width - 1 bytes into the window
        end = min(windows, place - k * width + 1)
        core = data[place - k * width : place - (k + 1) * width + 1 + length]
        out.append((xxhash.xxh3_64_intdigest(core, seed=k) - 2**63, at, end - at + length - 1))
        at = end
    return out


def _keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with a key of their own: 128 bits of id and text."""
    body = F.coalesce(text, F.lit("")).cast("binary")
    doc, mark = (F.xxhash64(F.lit(seed), F.col(doc_id).cast("bigint"), body) for seed in (1, 2))
    return docs.withColumns({"doc": doc, "mark": mark, "body": body})


def _all_chunks(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, cols, contents = [], [], []
                for body in part.column(2).to_pylist():
                    file, start, size = chunks(body, length)
                    n.append(len(file))
                    cols.append((file, start, size))
                    contents += [xxhash.xxh3_128_digest(body[a : a + s]) for a, s in zip(start.tolist(), size.tolist(), strict=True)]
                file, start, size = (np.concatenate(x) for x in zip(*cols, strict=True))
                which = np.repeat(np.arange(len(n)), n)
                content = np.frombuffer(b"".join(contents), np.int64).reshape(-1, 2)
                doc, mark = (c.to_numpy(zero_copy_only=False)[which] for c in (part.column(0), part.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(mark), pa.array(file), pa.array(content[:, 0].copy()), pa.array(content[:, 1].copy()), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32))], [c.split()[0] for c in CHUNKS.split(", ")])

    rows = _keyed(common.only(docs, "doc_id", "text")).select("doc", "mark", "body").where(F.octet_length("body") >= length)
    return rows.mapInArrow(run, CHUNKS)


_STRINGS = pa.schema([(c, pa.int64()) for c in ("file", *CONTENT, "copies", "doc", "mark")] + [("start", pa.int32()), ("bytes", pa.binary())])
STRINGS = "file bigint, content bigint, content2 bigint, copies bigint, doc bigint, mark bigint, start int, bytes binary"


def _fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """STRINGS: wanted (file, content, content2, copies, doc, mark, start, size) with the bytes of each chunk."""
    per_doc = wanted.groupBy("doc", "mark").agg(F.collect_list(F.struct("file", *CONTENT, "copies", "start", "size")).alias("wanted"))
    texts = _keyed(common.only(docs, "doc_id", "text")).select("doc", "mark", "body")
    one = texts.join(per_doc, ["doc", "mark"]).select("doc", "mark", "body", "wanted")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out = []
                for d, m, body, some in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    out += [{"doc": d, "mark": m, "bytes": body[w["start"] : w["start"] + w["size"]], **w} for w in some]
                yield pa.RecordBatch.from_pylist([{c: r[c] for c in _STRINGS.names} for r in out], _STRINGS)

    return one.mapInArrow(run, STRINGS).dropDuplicates(["file", *CONTENT])


def merged(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """[a, b) spans under the windows of length bytes at the sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return list(zip(starts[np.concatenate(([0], cut))].tolist(), (starts[np.concatenate((cut - 1, [len(starts) - 1]))] + length).tolist(), strict=True))


def _sorted_blocks(strings: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """(doc, mark, a, b): spans of chunks with a single copy that repeat in other chunks of their file."""

    def block(rows: list[tuple]) -> pa.RecordBatch:
        at = np.cumsum([0, *(len(r[4]) for r in rows)])
        valid = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(at[:-1], at[1:], strict=True)])
        starts = repeated_starts(b"".join(r[4] for r in rows), valid, length)
        owner = np.searchsorted(at, starts, "right") - 1
        out = []
        for i in np.unique(owner).tolist():
            doc, mark, copies, start, _ = rows[i]
            if copies == 1:
                out += [(doc, mark, start + a, start + b) for a, b in merged(starts[owner == i] - at[i], length)]
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["doc", "mark", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]):
        rows, size, last = [], 0, None
        for batch in batches:
            for file, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != last and size >= block_bytes:
                    yield block(rows)
                    rows, size = [], 0
                last = file
                rows.append(row)
                size += len(row[4])
        if rows:
            yield block(rows)

    dealt = strings.select("file", "doc", "mark", "copies", "start", "bytes").repartition("file").sortWithinPartitions("file")
    return dealt.mapInArrow(run, "doc bigint, mark bigint, a int, b int")


def _parted(strings: DataFrame, width: int, length: int) -> DataFrame:
    """STRINGS of the pieces of strings."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                out = []
                for r in batch.slice(at, 1024).to_pylist():
                    for file, start, size in parted(r["bytes"], width, length):
                        data = r["bytes"][start : start + size]
                        content = np.frombuffer(xxhash.xxh3_128_digest(data), np.int64).tolist()
                        out.append({**r, "file": file, "content": content[0], "content2": content[1], "start": r["start"] + start, "bytes": data})
                yield pa.RecordBatch.from_pylist(out, _STRINGS)

    return strings.mapInArrow(run, STRINGS)


def _filed_again(strings: DataFrame, length: int, file_chunks: int, widths: tuple[int, ...] = WIDTHS) -> tuple[DataFrame, list[DataFrame]]:
    """The strings (a table of ``materialize``) in files of at most file_chunks, and the spans that are known on the way.

    Equal pieces are repeats; one of them stays to be compared with others, with copies above 1. The
    last width is 1: a file is then one window, and has one string.
    """
    done, known = [], []
    for width in widths:
        large = strings.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > file_chunks)
        large = common.materialize(large, "large-files")
        if large.isEmpty():
            break
        total = large.agg(F.sum("n")).head()[0]
        done.append(strings.join(common.small(large), "file", "left_anti"))
        pieces = common.materialize(_parted(common.spread_join(strings, large, ["file"], total).drop("n"), width, length), "pieces")
        one = F.min_by(F.struct("copies", "doc", "mark", "start", "bytes"), F.struct("doc", "mark", "start"))
        groups = pieces.groupBy("file", *CONTENT).agg(F.count(F.lit(1)).alias("n"), one.alias("one"))
        groups = common.materialize(groups.select("file", *CONTENT, "n", "one.*").withColumn("copies", F.when(F.col("n") > 1, 2).otherwise(F.col("copies")).cast("bigint")), "groups")
        again = common.materialize(groups.where("n > 1").select("file", *CONTENT, "n"), "again")
        twice = common.spread_join(pieces.where("copies = 1"), again, ["file", *CONTENT], total)
        known.append(twice.select("doc", "mark", F.col("start").alias("a"), (F.col("start") + F.octet_length("bytes")).alias("b")))
        strings = groups.drop("n")
    for d in done:
        strings = strings.unionByName(d.select(*strings.columns))
    return strings, known


def spans(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, file_chunks: int = FILE_CHUNKS, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(doc, mark, spans) of the documents with repeats; spans may overlap."""
    every = common.materialize(_all_chunks(docs, length), "chunks")
    total = every.count()
    ends = (f(c).alias(f"{f.__name__}_{c}") for c in CONTENT for f in (F.min, F.max))
    files = every.groupBy("file").agg(F.count(F.lit(1)).alias("n"), *ends).where("n > 1")
    files = common.materialize(files.select("file", "n", F.expr("min_content <> max_content or min_content2 <> max_content2").alias("mixed")), "files")
    shared = common.materialize(common.spread_join(every, files, ["file"], total).drop("n"), "shared-chunks")
    common.release(every, files)
    span = ("doc", "mark", F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("b"))
    mixed = shared.where("mixed")
    different = mixed.groupBy("file", *CONTENT).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "mark", "start", "size")).alias("at"))
    different = common.materialize(different.select("file", *CONTENT, "copies", "at.*"), "different-chunks")
    again = common.materialize(different.where("copies > 1").select("file", *CONTENT, "copies"), "repeated-chunks")
    copies = common.spread_join(mixed, again, ["file", *CONTENT], total, "copies")
    strings = common.materialize(_fetched(docs, different), "strings")
    common.release(different)
    small_files, known = _filed_again(strings, length, file_chunks, widths)
    rows = shared.where("not mixed").select(*span)
    for found in (copies.select(*span), *known, _sorted_blocks(small_files, length, block_bytes)):
        rows = rows.unionByName(found)
    out = rows.groupBy("doc", "mark").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    out = common.materialize(out, "spans")
    common.release(shared, strings)
    return out


def _union(some: list[dict] | None) -> list[tuple[int, int]]:
    """The maximal runs under spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in some or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _kept(body: bytes, runs: list[tuple[int, int]]) -> bytes:
    keep, last = [], 0
    for a, b in runs:
        keep.append(body[last:a])
        last = b
    return b"".join([*keep, body[last:]])


def repeats(docs: DataFrame, length: int = LENGTH, **limits: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    found = spans(docs, length, **limits)
    rows = _keyed(common.only(docs, "doc_id", "text")).join(found, ["doc", "mark"], "left").select(F.col("doc_id").cast("bigint"), "body", "spans")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, bodies = batch.column(0), batch.column(1).to_pylist()
            runs = [_union(s) for s in batch.column(2).to_pylist()]
            sizes = [len(b) for b in bodies]
            kept = [_kept(b, r) for b, r in zip(bodies, runs, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array([n - len(k) for n, k in zip(sizes, kept, strict=True)], pa.int64()), pa.array([len(r) for r in runs], pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def remove(docs: DataFrame, length: int = LENGTH, **limits: int) -> DataFrame:
    """The documents without their repeats, other columns as they were.

    A character of which some bytes are removed goes with them. Documents of which nothing is left
    go. n_chars, if there, is counted anew for documents that were cut.
    """
    found = spans(docs, length, **limits)
    names = docs.columns
    rows, name = common.positional(docs)
    rows = _keyed(rows, name["doc_id"], name["text"]).drop("body").join(found, ["doc", "mark"], "left").select(*name.values(), "spans")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            at = names.index("text")
            texts, some = batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()
            chars = batch.column(names.index("n_chars")).to_pylist() if "n_chars" in names else None
            keep = []
            for i, s in enumerate(some):
                if s:
                    texts[i] = _kept(texts[i].encode(), _union(s)).decode(errors="ignore")
                    if chars:
                        chars[i] = len(texts[i])
                if not s or texts[i]:
                    keep.append(i)
            cols = list(batch.columns)[: len(names)]
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            if chars:
                cols[names.index("n_chars")] = pa.array(chars, batch.schema.field(names.index("n_chars")).type)
            yield pa.RecordBatch.from_arrays(cols, names).take(pa.array(keep, pa.int64()))

    return rows.mapInArrow(run, docs.schema)

