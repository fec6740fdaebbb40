"""Near-duplicate groups by circulant MinHash.

A document's set is its distinct 5-word shingles. All signature coordinates come from two
permutations: the first (a bijective 64-bit mix) scatters the shingles over the cells of a circle,
the second orders the cells, and coordinate k is the smallest order under the first permutation's
cells shifted by k: one contiguous slice of the second permutation per shingle. Bands of
coordinates give candidate buckets; links are confirmed by the exact Jaccard similarity of the full
sets, and groups are the connected components of the links.

With 40 bands of 7 coordinates a pair at similarity 0.85 shares no bucket with probability 2e-7, one
at 0.80 with 8e-5 (for independent coordinates; recall by similarity has not been measured).

Shingles are named by 64 bits: words of up to 16 bytes enter with all their bytes, longer ones by
xxh3, and every step mixes non-linearly, so no family of texts is bound to collide.

Large groups: equal sets are one node from the start. In every bucket that spans several components a
pivot is compared with the members of other components, first the smallest id, then the most central
text, as long as that settles enough. What remains is settled around hubs, central texts, by what
each member differs from the hub in: a pair can only be linked if these differences have enough in
common, which bounds and an equi join on the rarest of them decide. So no pairs of a group of copies
are listed, and yet every candidate pair is either compared, ruled out by a bound, or already
connected.

Defined results: null text, or text without words, has an empty set and no links; fewer words than
a shingle give one shingle of all words; rows with a null id are linked with nothing and kept; rows
that share an id and a set are one node, rows that share only an id are nodes of their own; whole
texts count, however long; an empty table gives no rows; other columns, whatever their names, are
ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from . import common, graph

SHINGLE, BANDS, ROWS = 5, 40, 7
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 80
CELLS = 1 << 20
#: Buckets get further pivots while a turn brings their members below this share of what they were.
WORTH_A_TURN = 0.9
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
#: The lowest k bytes of a word of 8.
_LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_BASE = 0x9E3779B97F4A7C15
FEATURES = "doc_id bigint, n_shingles bigint, fingerprint binary, bands array<bigint>"


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, as many as texts needed so far."""

    def __init__(self, base: int = _BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n2 = max(n, 2 * len(self.up), 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = np.full(n2, b, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up[:n], self.down[:n]


powers = Powers()


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers (xor-shift-multiply)."""
    h = h + np.uint64(seed)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_names(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit names of the words of data."""
    padded = np.frombuffer(data + bytes(24), np.uint8)
    eight = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
    size = end - start
    low = eight[start] & _LOWEST[np.minimum(size, 8)]
    high = eight[start + 8 * (size > 8)] & _LOWEST[np.clip(size - 8, 0, 8)]
    names = mix(mix(low + size.astype(np.uint64) * np.uint64(_BASE)) + high)
    for i in np.flatnonzero(size > 16).tolist():
        names[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]])
    return names


def _names(words: np.ndarray, size: int) -> np.ndarray:
    """Names of all runs of size words."""
    names = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        names = mix(names + words[k : k + len(names)], k + 1)
    return names


def _distinct(names: np.ndarray) -> np.ndarray:
    names = np.sort(names)
    return names[np.concatenate(([True], names[1:] != names[:-1]))]


def shingle_sets(texts: list[str | None], size: int = SHINGLE, together: int = 1 << 20) -> Iterator[np.ndarray]:
    """The set of each text, as sorted 64-bit names; texts are worked on together, about so many bytes at once."""
    some, held = [], 0
    for text in texts:
        some.append(text.encode() if text else b"")
        held += len(some[-1])
        if held >= together:
            yield from _sets(some, size)
            some, held = [], 0
    yield from _sets(some, size)


def _sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    if not texts:
        return
    data = b" ".join(texts).translate(_LOWER)
    edges = np.flatnonzero(np.diff(~_SPACE[np.frombuffer(b" " + data + b" ", np.uint8)]))
    start = edges[::2]
    words = word_names(data, start, edges[1::2])
    names = _names(words, size) if len(words) >= size else None
    ends = np.cumsum([len(t) + 1 for t in texts])
    last = np.searchsorted(start, ends).tolist()
    for a, b in zip([0, *last[:-1]], last, strict=True):
        if a == b:
            yield np.empty(0, np.uint64)
        else:
            yield _distinct(names[a : b - size + 1]) if b - a >= size else _names(words[a:b], b - a)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    return next(shingle_sets([text], size))


def fingerprint(hashes: np.ndarray) -> bytes | None:
    """128 bits that tell sets apart; none for the empty one."""
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


@functools.lru_cache(1)
def second_permutation(width: int) -> np.ndarray:
    """Row c: the orders of the cells c, c + 1, ..., around the circle."""
    order = np.random.default_rng(20_240_601).permutation(CELLS).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate((order, order[:width])), width)


def signature(hashes: np.ndarray, width: int = BANDS * ROWS, step: int = 1024) -> np.ndarray:
    circle = second_permutation(width)
    cells = (mix(hashes, 1) >> np.uint64(44)).astype(np.int64)
    best = np.full(width, CELLS, np.int32)
    for i in range(0, len(cells), step):
        np.minimum(best, circle[cells[i : i + step]].min(axis=0), out=best)
    return best


_FACTORS = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    return mix((rows * _FACTORS).sum(axis=1, dtype=np.uint64) + mix(np.arange(BANDS, dtype=np.uint64), 7)).view(np.int64)


def features(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                n, prints, bands = [], [], []
                for s in shingle_sets(part.column(1).to_pylist()):
                    n.append(len(s))
                    prints.append(fingerprint(s))
                    bands.append(band_keys(signature(s)) if len(s) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "fingerprint", "bands"])

    return common.only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(run, FEATURES)


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, hashes) of the wanted nodes (id, doc_id, fingerprint), from a document of each."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, sets = [], []
                known, prints, texts = (c.to_pylist() for c in batch.slice(at, 256).columns)
                for i, print_, s in zip(known, prints, shingle_sets(texts), strict=True):
                    if fingerprint(s) == print_:  # else it is another text of the same id
                        ids.append(i)
                        sets.append(s.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["id", "hashes"])

    texts = common.only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text")
    found = texts.join(common.small(wanted), "doc_id").select("id", "fingerprint", "text").mapInArrow(run, "id bigint, hashes binary")
    return found.groupBy("id").agg(F.first("hashes").alias("hashes"))  # repeated rows give a set more than once


#: Rows that get one copy of a set in a join; a hot document's set is copied as often as its rows need.
ROWS_A_COPY = 2000


def _beside(rows: DataFrame, sets: DataFrame, end: str, name: str) -> DataFrame:
    """rows with the set of the document in the column end, under name; no document's rows go to one task."""
    sizes = rows.groupBy(end).agg(F.ceil(F.count(F.lit(1)) / ROWS_A_COPY).cast("int").alias("copies")).where("copies > 1")
    sizes = common.small(common.materialize(sizes, "hot-documents"))
    spread = F.pmod(F.xxhash64(*(c for c, t in rows.dtypes if t == "bigint")), F.coalesce("copies", F.lit(1))).cast("int")
    left = rows.join(sizes, end, "left").withColumn("copy", spread).drop("copies")
    right = sets.select(F.col("id").alias(end), F.col("hashes").alias(name)).join(sizes, end, "left")
    right = right.select(end, name, F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy"))
    return left.join(right, [end, "copy"]).drop("copy")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), a table of ``materialize``, whose sets are alike enough."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            good = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate((x, y)))
                common_ = int((both[1:] == both[:-1]).sum())
                good[i] = 100 * common_ >= percent * (len(both) - common_)
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], ["a", "b"])

    both = _beside(_beside(pairs.select("a", "b"), sets, "b", "second"), sets, "a", "first")
    return both.select("a", "b", "first", "second").mapInArrow(run, "a bigint, b bigint")


def _shared_counts(sets: DataFrame, active: DataFrame) -> DataFrame:
    """(id, most): how many of a document's shingles active documents of other components have as well."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i, r, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = np.frombuffer(h, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), i)), pa.array(np.full(len(hashes), r)), pa.array(hashes)], ["id", "root", "hash"])

    ids = common.materialize(active.select("id", "root").distinct(), "active-ids")
    rows = sets.join(common.small(ids), "id").select("id", "root", "hashes").mapInArrow(run, "id bigint, root bigint, hash bigint")
    rows = common.materialize(rows, "active-shingles")
    apart = rows.groupBy("hash").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("hash")
    out = common.materialize(rows.join(apart, "hash", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("most")), "shared-counts")
    common.release(rows, ids)
    return out


def _without_partners(active: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Active members that can still have a link in their bucket, with most, a bound of their intersections.

    What a text shares with another is at most what it shares with all others together; with that
    and the smallest size in the bucket, most texts that are merely similar drop out uncompared.
    """
    counts = common.small(_shared_counts(sets, active))
    bounded = active.drop("most").join(counts, "id")
    least = bounded.groupBy("key").agg(F.min("n").alias("least_n"), F.max("most").alias("largest"))
    common_ = F.least("most", "largest")
    possible = 100 * common_ >= percent * (F.col("n") + F.greatest("least_n", common_) - common_)
    left = bounded.join(common.small(common.materialize(least, "bounds")), "key").where(possible)
    return left.select("key", "id", "n", "root", "most")


def _unfinished(active: DataFrame) -> DataFrame:
    """The members of buckets that span several components."""
    spread = active.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    spread = common.small(common.materialize(spread, "spread"))
    return common.materialize(active.join(spread, "key", "left_semi").select("key", "id", "n", "root", "most"), "active")


def _pooled(active: DataFrame) -> DataFrame:
    """Active members with buckets of one most common component as one bucket, named by that: members that share a bucket still do."""
    sizes = active.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    chosen = common.materialize(sizes.groupBy("key").agg(F.max_by("root", F.struct("c", -F.col("root"))).alias("pool")), "chosen")
    rows = active.join(common.small(chosen), "key").groupBy("pool", "id").agg(*(F.min(c).alias(c) for c in ("n", "root", "most")))
    return common.materialize(rows.withColumnRenamed("pool", "key"), "active")


def _balls(active: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) to hubs, and the members of balls: (hub, hub_root, id, n, root, d, difference).

    A bucket's hub is the most central text of its most common component. A member's difference are
    the shingles that it or the hub has alone; d is their number. A member that is linked with the
    hub counts as one of its component.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sizes, d, difference = [], [], []
            for x, h in zip(batch.column(5), batch.column(6), strict=True):
                both = np.sort(np.concatenate((np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(h.as_buffer(), np.uint64))))
                twin = np.concatenate((both[1:] == both[:-1], [False]))
                twin[1:] |= twin[:-1]
                sizes.append(len(h.as_buffer()) // 8)
                difference.append(both[~twin].view(np.int64))
                d.append(len(difference[-1]))
            cols = [*batch.columns[:5], pa.array(sizes, pa.int64()), pa.array(d, pa.int64()), pa.array(difference, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["hub", "hub_root", "id", "n", "root", "hub_n", "d", "difference"])

    keep, small = common.materialize, common.small
    hubs = active.groupBy("root").agg(F.max_by("id", F.struct(F.col("most") / F.col("n"), "id")).alias("hub"))
    hubs = keep(hubs.withColumnRenamed("root", "hub_root"), "hubs")
    ball = _pooled(active).withColumnRenamed("key", "hub_root")
    ball = keep(ball.join(small(hubs), "hub_root").select("hub", "hub_root", "id", "n", "root"), "balls")
    own = sets.select("id", F.col("hashes").alias("own")).join(small(ball), "id")
    both = _beside(own, sets, "hub", "hub_hashes").select("hub", "hub_root", "id", "n", "root", "own", "hub_hashes")
    rows = keep(both.mapInArrow(run, "hub bigint, hub_root bigint, id bigint, n bigint, root bigint, hub_n bigint, d bigint, difference array<bigint>"), "ball-members")
    linked = (100 + percent) * F.col("d") <= (100 - percent) * (F.col("n") + F.col("hub_n"))
    links = rows.where(linked & (F.col("root") != F.col("hub_root"))).select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
    return links, rows.select("hub", "hub_root", "id", "n", F.when(linked, F.col("hub_root")).otherwise(F.col("root")).alias("root"), "d", "difference")


def _ball_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of members of a ball, of different components, that can be linked.

    x and y differ in d_x + d_y - 2 o shingles, o being what their differences from the hub have in
    common, and they are linked if that is at most a share of n_x + n_y. Pairs that need no o are both
    linked with the hub, so they are of one component. All others have o >= 1, and x has a lower bound
    of o from the d and n of all possible partners. So it drops out if fewer of its shingles than that
    are those of another component's member, or if no such member has enough of them; else a pair meets
    in an equi join on the shingles that are rarest in the ball, all but one less than the bound.
    """
    for _ in range(2):  # what drops out makes the bounds of others tighter
        tokens = members.select("hub", "id", "root", F.explode("difference").alias("shingle"))
        apart = tokens.groupBy("hub", "shingle").agg(F.count(F.lit(1)).alias("c"), F.min("root").alias("low"), F.max("root").alias("high"))
        apart = apart.where("low <> high").select("hub", "shingle", "c")
        shared = tokens.join(apart, ["hub", "shingle"]).groupBy("hub", "id").agg(F.array_sort(F.collect_list(F.struct("c", "shingle"))).alias("shared"))
        rows = common.materialize(members.join(shared, ["hub", "id"]), "ball-shingles")
        # x and y are linked if v_x + v_y <= 2 (100 + percent) o
        both, out = 2 * (100 + percent), F.col("root") != F.col("hub_root")
        rows = rows.withColumn("v", (100 + percent) * F.col("d") - (100 - percent) * F.col("n"))
        stats = ((F.min, F.col("v"), "least"), (F.max, both * F.size("shared") - F.col("v"), "reach"))
        limits = rows.groupBy("hub").agg(*(f(c).alias(n) for f, c, n in stats), *(f(F.when(out, c)).alias(f"out_{n}") for f, c, n in stats))
        rows = rows.join(common.small(common.materialize(limits, "ball-limits")), "hub")
        # partners of a member of the hub's component are outside of it
        least, reach = (F.when(out, F.col(c)).otherwise(F.col(f"out_{c}")) for c in ("least", "reach"))
        rows = rows.withColumn("bound", F.greatest(F.lit(1), F.ceil((F.col("v") + least) / both)).cast("int"))
        left = rows.where((F.size("shared") >= F.col("bound")) & (F.col("v") <= reach))
        rows = common.materialize(left, "ball-rest")
        members = rows.select("hub", "hub_root", "id", "n", "root", "d", "difference")
    # rows has the counts of the last turn, so the order of shingles is the same for all
    prefix = F.slice("shared", F.lit(1), F.size("shared") - F.col("bound") + 1)
    rare = rows.select("hub", "id", "n", "root", "v", F.size("shared").alias("left"), F.posexplode(prefix).alias("place", "t"))
    rare = rare.select("hub", "id", "n", "root", "v", F.col("t.shingle").alias("shingle"), (F.col("left") - F.col("place")).alias("left"))
    rare = common.materialize(rare, "ball-prefixes")
    names = {c: f"other_{c}" for c in ("id", "n", "root", "v", "left")}
    alike = 100 * F.least("n", "other_n") >= percent * F.greatest("n", "other_n")
    # from their first common shingle on, they can have no more in common than is left of either
    enough = F.col("v") + F.col("other_v") <= both * F.least("left", "other_left")
    differ = (F.col("id") < F.col("other_id")) & (F.col("root") != F.col("other_root"))
    meet = rare.join(rare.select("hub", "shingle", *(F.col(c).alias(o) for c, o in names.items())), ["hub", "shingle"])
    return meet.where(differ & alike & enough).select(F.col("id").alias("a"), F.col("other_id").alias("b")).distinct()


def _merged(roots: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """roots after the links, and (root, new) of the roots that moved, if any link was there."""
    if links.isEmpty():
        return roots, None
    between = links
    for end in ("a", "b"):
        between = between.join(common.small(roots).select(F.col("id").alias(end), F.col("root").alias(f"root_{end}")), end)
    found = graph.components(between.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    moved = common.small(found).select(F.col("id").alias("root"), F.col("root").alias("new"))
    return common.materialize(roots.join(moved, "root", "left").select("id", F.coalesce("new", "root").alias("root")), "roots"), moved


def _links(docs: DataFrame, nodes: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(id, root) of all candidates. members: (key, id, n), the buckets of two and more."""
    keep, spark = common.materialize, docs.sparkSession
    roots = keep(members.select("id").distinct().withColumn("root", F.col("id")), "roots")
    wanted = keep(nodes.select("id", "doc_id", "fingerprint").join(common.small(roots), "id", "left_semi"), "wanted")
    sets = keep(_full_sets(docs, wanted), "sets")
    common.forget(spark)
    active = members.withColumns({"root": F.col("id"), "most": F.col("n")})
    before = None
    while True:
        if before is None:
            chosen = active.groupBy("key").agg(F.min(F.struct("id", "n", "root")).alias("p"))
        else:  # the most central text: the one with the least that is its own
            central = F.struct(F.col("most") / F.col("n"), F.xxhash64("id"), "id")
            chosen = active.groupBy("key").agg(F.max_by(F.struct("id", "n", "root"), central).alias("p"))
        chosen = keep(chosen.select("key", F.col("p.id").alias("hub"), F.col("p.n").alias("m"), F.col("p.root").alias("hub_root")), "pivots")
        alike = (F.col("root") != F.col("hub_root")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
        pairs = active.join(common.small(chosen), "key").where(alike).select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
        pairs = keep(pairs.distinct(), "pairs")
        roots, moved = _merged(roots, keep(_confirm(pairs, sets, percent), "confirmed"))
        active = active.join(common.small(chosen).select("key", F.col("hub").alias("id")), ["key", "id"], "left_anti")
        if moved is not None:
            active = active.join(moved, "root", "left").select("key", "id", "n", F.coalesce("new", "root").alias("root"), "most")
        active = _unfinished(active)
        if not active.isEmpty():
            active = _unfinished(_without_partners(active, sets, percent))
        if before is None:
            active = _pooled(active)
        del chosen, pairs, moved
        left = active.count()
        if not left:
            return roots
        if before is not None and left > WORTH_A_TURN * before:
            break
        before = left
    hub_links, balls = _balls(active, sets, percent)
    pairs = keep(_ball_pairs(balls, percent), "ball-pairs")
    return _merged(roots, keep(_confirm(pairs, sets, percent).union(hub_links), "confirmed"))[0]


def _components(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """FEATURES of all rows, and (fingerprint, component_id) of the sets that are not alone."""
    rows = common.materialize(features(docs), "minhash")
    named = rows.where("doc_id is not null and fingerprint is not null")
    nodes = named.groupBy("fingerprint").agg(
        F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies")
    )
    # ids of nodes are given when the table is written: two texts may share a document's id
    nodes = common.materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    entries = nodes.select("id", "n", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    members = common.materialize(entries.join(shared, "key").select("key", "id", "n"), "buckets")
    roots = _links(docs, nodes, members, percent) if not members.isEmpty() else members.select("id", F.col("id").alias("root"))
    known = nodes.select("fingerprint", "doc_id", "copies", "id").join(roots, "id", "left").where("copies > 1 or root is not null")
    known = common.materialize(known.select("fingerprint", "doc_id", "root"), "named-roots")
    least = common.materialize(known.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least")), "least-ids")
    out = known.join(common.small(least), "root", "left").select("fingerprint", F.coalesce("least", "doc_id").alias("component_id"))
    return rows, common.materialize(out, "components")


def _judged(rows: DataFrame, components: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fingerprint, component_id, kept."""
    out = rows.select("doc_id", "n_shingles", "fingerprint").join(common.small(components), "fingerprint", "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    return _judged(*_components(docs, percent)).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, all columns as they were: the one of the smallest id.

    Of rows that share an id, those whose own set is a copy of another id's go, the others stay; of
    rows that share both id and set, one stays.
    """
    judged = _judged(*_components(docs, percent)).where("doc_id is not null")
    copy = F.when(~F.col("kept"), F.col("fingerprint"))
    ids = judged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.bool_or("kept").alias("any"), F.collect_set(copy).alias("copies"))
    ids = common.materialize(ids.where("rows > 1 or not any").select("doc_id", "any", "copies"), "copies")
    rows, name = common.positional(docs)
    own, at, width, names = F.col(name["doc_id"]).cast("bigint"), list(name).index("text"), len(name), [*name.values(), "print"]
    left = rows.join(common.small(ids.select("doc_id"), of=ids), own == F.col("doc_id"), "left_anti")
    twice = ids.where("any")
    if not twice.isEmpty():  # ids with several rows, some of which stay

        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                prints = [fingerprint(s) or b"" for s in shingle_sets(batch.column(at).to_pylist())]
                good = [p not in c for p, c in zip(prints, batch.column(width).to_pylist(), strict=True)]
                cols = [*batch.columns[:width], pa.array(prints, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names).filter(pa.array(good, pa.bool_()))

        some = rows.join(twice.select("doc_id", "copies"), own == F.col("doc_id")).select(*name.values(), "copies")
        some = some.mapInArrow(run, StructType([*rows.schema.fields, StructField("print", BinaryType())])).dropDuplicates([name["doc_id"], "print"])
        left = left.unionByName(some.select(*name.values()))
    return left.toDF(*docs.columns)
