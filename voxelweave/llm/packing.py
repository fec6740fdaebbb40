"""Best-fit-decreasing packing of tokenised documents into fixed-size sequences.

Tokenising is the only pass over the texts and keeps just the layout of each piece. Best-fit
decreasing looks at lengths alone, so the plan is made from the histogram of piece lengths (at most
``capacity`` rows, whatever the corpus): a segment tree over remaining capacities gives the tightest
open bins in O(log capacity), and equal bins are handled as runs. The result equals best-fit
decreasing run piece by piece over the whole corpus. Pieces then find their place by their rank
within their length; ranks are counted in hashed buckets, so that a length that most pieces share
is spread over many tasks.

Defined results: null text is empty (only the end id); documents sharing an id, or with a null id,
are packed as separate documents; an empty table gives no rows; other columns, whatever their names, are
ignored. A text of any length is encoded whole, in one task, and cut into pieces; none of it is left out.
"""

from __future__ import annotations

import functools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
CAPACITY = 1024
END_ID = 2
#: White space that pattern engines may class differently, and the start of special tokens.
_APART = ["\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", "<|"]
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def files(tokenizer: str | None) -> tuple[str, str | None]:
    """The tokenizer's file, and that of its ranks where it is the default."""
    import public_tokenizers

    return (tokenizer, None) if tokenizer else (public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS))


class Encoder:
    """Token ids of texts, as little-endian 32-bit bytes.

    The ids are those of ``tokenizers`` with the given file. Where ``ranks`` names the same
    vocabulary in tiktoken's form, texts of Latin-1 letters and plain white space are encoded with
    that, which is three times as fast: on those characters the two libraries' patterns agree.
    Any other text, and one with a special token's string, goes through ``tokenizers``.
    """

    def __init__(self, path: str, ranks: str | None):
        self.path, self.fast = path, None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    @functools.cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> bytes:
        if self.fast and not any(c in text for c in _APART):
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@functools.lru_cache(2)
def encoder(path: str, ranks: str | None) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path, ranks)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; the first piece takes the remainder."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _encoded(batches: Iterator[pa.RecordBatch], paths: tuple, end_id: int, step: int = 256) -> Iterator[tuple]:
    encode, end = encoder(*paths), np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            texts = (t or "" for t in part.column(1).to_pylist())
            yield part.column(0).to_pylist(), [encode(t) + end for t in texts]


def tokenize(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: its place in the document, and a checksum of its ids."""
    paths = files(tokenizer)

    def run(batches):
        for doc_ids, encoded in _encoded(batches, paths, end_id):
            out = [(d, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])) for d, ids in zip(doc_ids, encoded, strict=True) for k, (s, n) in enumerate(cut(len(ids) // 4, capacity))]
            cols = list(zip(*out, strict=True))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return common.only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(run, PIECES)


class CapacityTree:
    """Segment tree over remaining capacities: how many open bins have each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, remaining: int, bins: int) -> None:
        i = remaining + self.size
        while i:
            self.count[i] += bins
            i >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity that holds length, of those that open bins have."""
        i = length + self.size
        if self.count[i]:
            return length
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan_best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Best-fit decreasing over lengths with counts.

    Rows of the plan: length, first rank, pieces, first bin, pieces a bin, offset in the bin. The
    pieces of a length, by rank, go to consecutive bins of a run. Returns the plan and the number
    of bins. Its size depends on capacity only, not on the counts.
    """
    tree, runs, plan, bins = CapacityTree(capacity), defaultdict(list), [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, have, first = capacity, left, bins
                each = room // length
                use = -(-left // each)
                bins += use
            else:
                first, have = runs[room].pop()
                each = room // length
                use = min(have, -(-left // each))
                tree.add(room, -use)
                if have > use:
                    runs[room].append((first + use, have - use))
            take = min(left, use * each)
            plan.append((length, rank, take, first, each, capacity - room))
            full, rest = divmod(take, each)
            for at, n, after in ((first, full, room - each * length), (first + full, int(rest > 0), room - rest * length)):
                if n:
                    runs[after].append((at, n))
                    tree.add(after, n)
            left, rank = left - take, rank + take
    return np.array(plan, np.int64).reshape(-1, 6), bins


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The layout: PIECES with sequence_id and offset."""
    spark = docs.sparkSession
    pieces = common.materialize(tokenize(docs, tokenizer, capacity, end_id), "pieces")
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    plan, _ = plan_best_fit(histogram, capacity)
    shared = spark.sparkContext.broadcast(plan)  # its size is bounded by capacity
    buckets = max(64, sum(histogram.values()) // 100_000)
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = pieces.withColumn("within", within).join(before, ["length", "bucket"])

    def place(batches):
        plan = shared.value
        order = np.lexsort((plan[:, 1], plan[:, 0]))
        plan = plan[order]
        base = int(plan[:, 1].max() + plan[:, 2].max() + 1)
        keys = plan[:, 0] * base + plan[:, 1]
        for pdf in batches:
            rank = pdf.pop("rank").to_numpy()
            row = plan[np.searchsorted(keys, pdf["length"].to_numpy() * base + rank, "right") - 1]
            nth, at = np.divmod(rank - row[:, 1], row[:, 4])
            yield pdf.assign(sequence_id=row[:, 3] + nth, offset=row[:, 5] + at * row[:, 0])

    cols = [*(x.split()[0] for x in PIECES.split(", ")), (F.col("before") + F.col("within") - 1).alias("rank")]
    return ranked.select(*cols).mapInPandas(place, PIECES + ", sequence_id bigint, offset bigint") if histogram else pieces.drop("bucket").withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")})


def sequences(docs: DataFrame, layout: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed ids themselves: (sequence_id, ids). Documents need distinct ids here."""
    paths = files(tokenizer)

    def run(batches):
        for doc_ids, encoded in _encoded(batches, paths, end_id):
            out = [(d, k, np.frombuffer(ids[4 * s : 4 * (s + n)], "<i4")) for d, ids in zip(doc_ids, encoded, strict=True) for k, (s, n) in enumerate(cut(len(ids) // 4, capacity))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.list_(pa.int32()))], ["doc_id", "piece", "ids"])

    ids = common.only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(run, "doc_id bigint, piece int, ids array<int>")
    parts = ids.join(layout.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most capacity pieces
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids"))
