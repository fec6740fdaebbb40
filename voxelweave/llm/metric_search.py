"""Exact top-k inner-product search with M-trees.

Inner product becomes a metric by one more coordinate: with M the largest norm of all rows,
x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) have squared distance |q|^2 + M^2 - 2 q.x, so the
nearest rows are those of the highest scores.

The upper level is distributed: at most ``PIVOTS`` rows, chosen by a hash, are routing objects, and
every row goes to the nearest one, with its distance; the largest of these is the covering radius.
Each such block (a block of more than ``BLOCK_ROWS`` rows is several parts) bulk-loads an M-tree:
pages of routing objects with covering radii and distances to their parent. A query first visits
its own block; its k-th score there is a bound, with which it goes only to the blocks that the bound
allows. Within a tree the search is best-first: a page is opened by the lower bound of its
distances, and an entry whose parent distance already rules it out by the triangle inequality is
never compared. Queries that meet in a tree go through it together, each by its own bounds. Scores themselves
are exact integers. A part of a block holds about ``PART_BYTES`` of vectors, however wide these are.

Defined results: vectors that are null, empty or hold null or non-finite components take no part,
neither do rows with a null id; vectors are compared with those of their own length, however long;
rows that share a query's id are its own; components beyond 2^31 (after scaling) are refused with an
error. Ties go to the smaller id. Rows count as often as they are there, as in the SQL: each copy of a
row takes a rank of its own, and the rows of a repeated query id share one list of k, to which each
brings its own candidates. An empty table gives no rows; other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Entries of a leaf, and of a routing page, at most.
PAGE, FANOUT = 32, 4
#: Rows of a part of a block, about; routing objects of the upper level, at least and at most.
BLOCK_ROWS, LEAST_BLOCKS, PIVOTS = 50_000, 12, 4096
_SLACK = 1e-6
#: Bytes of the vectors of a part, about, and queries that go through a tree together.
PART_BYTES, TOGETHER = 32 << 20, 256
#: The score of no entry.
NONE = np.iinfo(np.int64).min


def distance(base: float, score: int) -> float:
    """The distance of a row of this score from a query with |q|^2 + M^2 = base, with room for rounding in float64."""
    return float(np.sqrt(max(base - 2.0 * score, 0.0))) + _SLACK * (1 + float(np.sqrt(base)))


class MTree:
    """A bulk-loaded M-tree over integer vectors under the augmented metric."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: int):
        self.ids, self.v, self.top = ids, vectors.astype(np.float64), float(top)
        self.rest = np.sqrt(np.maximum(top - (self.v * self.v).sum(1), 0))
        # float64 sums are exact below 2^53
        self.exact = self.v if top < 2**52 else vectors
        # a page: (is_leaf, row of each entry's object, its distance to the page's own object, radius, child page)
        self.pages: list[tuple] = []
        self.compared = 0
        self.root = self._page(np.arange(len(ids)), None) if len(ids) else None

    def _distance(self, rows: np.ndarray, to: int) -> np.ndarray:
        d = self.v[rows] - self.v[to]
        return np.sqrt((d * d).sum(1) + (self.rest[rows] - self.rest[to]) ** 2)

    def _page(self, rows: np.ndarray, parent: int | None) -> int:
        if len(rows) <= PAGE:
            near = self._distance(rows, parent) if parent is not None else None
            self.pages.append((True, rows, near, None, None))
            return len(self.pages) - 1
        chosen = [int(rows[0])]
        least = self._distance(rows, chosen[0])
        owner = np.zeros(len(rows), int)
        while len(chosen) < FANOUT and least.max() > 0:  # of those as far as most are from the objects so far
            far = int(rows[np.argsort(least, kind="stable")[len(rows) * 3 // 4 :]][0])
            if not least[rows == far][0]:
                far = int(rows[least.argmax()])
            d = self._distance(rows, far)
            owner[d < least] = len(chosen)
            least = np.minimum(least, d)
            chosen.append(far)
        if len(chosen) == 1:  # all rows are the same point
            parts = np.array_split(rows, min(FANOUT, -(-len(rows) // PAGE)))
            objects = [int(p[0]) for p in parts]
        else:
            parts, objects = [rows[owner == k] for k in range(len(chosen))], chosen
        children = [self._page(p, o) for p, o in zip(parts, objects, strict=True)]
        radius = np.array([self._distance(p, o).max() for p, o in zip(parts, objects, strict=True)])
        routing = np.array(objects)
        near = self._distance(routing, parent) if parent is not None else None
        self.pages.append((False, routing, near, radius, np.array(children)))
        return len(self.pages) - 1

    def search(self, query: np.ndarray, own: int | None, k: int, floor: int | None = None) -> list[tuple[int, int]]:
        """The k best (score, id), by score down and id up; of those below the score floor some may be missing."""
        scores, ids = self.search_all(query[None], [own], k, [floor])
        return [(s, i) for s, i in zip(scores[0].tolist(), ids[0].tolist(), strict=True) if s > NONE]

    def search_all(self, queries: np.ndarray, own: list[int | None], k: int, floors: list[int | None]) -> tuple[np.ndarray, np.ndarray]:
        """``search`` of several queries at once: scores and ids, a row for each query; places left over have the score NONE.

        Each query opens the pages that its own bound allows. They share one queue, in which a page has the
        lowest bound of the queries that wait for it; those that still want it when it comes up see its entries together.
        """
        m = len(queries)
        best = _Best(m, k)
        if self.root is None:
            return best.scores, best.ids
        q = queries.astype(np.float64)
        base = (q * q).sum(1) + self.top
        limit = np.array([np.inf if f is None else distance(float(b), f) for b, f in zip(base, floors, strict=True)])  # of each k-th best
        mine = np.array([NONE if o is None else o for o in own])
        queue: list[tuple] = [(0.0, self.root, np.arange(m), np.zeros(m), None)]
        while queue:
            least, page, who, bound, to_parent = heapq.heappop(queue)
            if least > limit.max():
                break
            wanted = bound <= limit[who]
            who = who[wanted]
            if not len(who):
                continue
            leaf, rows, near, radius, children = self.pages[page]
            may = np.ones((len(who), len(rows)), bool)
            if near is not None and to_parent is not None:
                to_parent = to_parent[wanted]
                may = np.abs(to_parent[:, None] - near) <= (limit[who][:, None] if leaf else limit[who][:, None] + radius)
            if leaf:  # however many own rows there are, they take no place among the best
                may &= (self.ids[rows] != mine[who][:, None]) | (mine[who] == NONE)[:, None]
            pick = np.flatnonzero(may.any(0))
            if not len(pick):
                continue
            rows, may = rows[pick], may[:, pick]
            self.compared += int(may.sum())
            if leaf:
                scores = (q if self.exact is self.v else queries)[who] @ self.exact[rows].T
                changed = best.add(who, np.where(may, scores.astype(np.int64), NONE), self.ids[rows])
                if len(changed):
                    worst = best.scores[changed, k - 1]
                    full = changed[worst > NONE]
                    far = np.sqrt(np.maximum(base[full] - 2.0 * worst[worst > NONE], 0)) + _SLACK * (1 + np.sqrt(base[full]))
                    limit[full] = np.minimum(limit[full], far)
            else:
                d = np.sqrt(np.maximum(base[who][:, None] - 2.0 * (q[who] @ self.v[rows].T), 0))
                go = may & (d - radius[pick] <= limit[who][:, None])
                for j, child in enumerate(children[pick].tolist()):
                    some = np.flatnonzero(go[:, j])
                    if len(some):
                        low = np.maximum(d[some, j] - radius[pick[j]] - _SLACK, 0.0)
                        heapq.heappush(queue, (float(low.min()), child, who[some], low, d[some, j]))
        return best.scores, best.ids


class _Best:
    """The k best entries of each query, by score down and id up."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores, self.ids = np.full((queries, k), NONE), np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Entries (scores: a row for each of who, a column for each id); returns the queries that have new ones."""
        k, least = self.k, self.scores[who, self.k - 1]
        if len(ids) > k:
            least = np.maximum(least, np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k])
        at, col = np.nonzero((scores >= least[:, None]) & (scores > NONE))
        if not len(at):
            return at
        new = np.unique(at)
        owner = np.concatenate((np.repeat(new, k), at))
        score = np.concatenate((self.scores[who[new]].ravel(), scores[at, col]))
        ident = np.concatenate((self.ids[who[new]].ravel(), ids[col]))
        order = np.lexsort((ident, ~score, owner))
        first = np.flatnonzero(np.concatenate(([True], np.diff(owner[order]) != 0)))
        keep = order[first[:, None] + np.arange(k)]
        self.scores[who[new]], self.ids[who[new]] = score[keep], ident[keep]
        return who[new]


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and v, the scaled components rounded down; rows that take no part are left out."""
    x = common.only(vectors, "vec_id", "embedding").where("vec_id is not null and embedding is not null and size(embedding) > 0")
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return x.where(fine).select(F.col("vec_id").cast("bigint"), F.transform("embedding", lambda c: F.floor(c.cast("double") * scale)).alias("v"))


class Upper:
    """The routing objects of the upper level, by vector length."""

    def __init__(self, vectors: list[list[int]], top: int):
        self.top, self.by_length = float(top), {}
        for n in {len(v) for v in vectors}:
            v = np.unique(np.array([v for v in vectors if len(v) == n], np.float64), axis=0)
            self.by_length[n] = v, self._rest(v)

    def _rest(self, v: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.top - (v * v).sum(1), 0))

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, distance from its object) of each row; a length without objects is one block."""
        if v.shape[1] not in self.by_length:
            return np.zeros(len(v), np.int32), np.full(len(v), np.inf)
        objects, rest = self.by_length[v.shape[1]]
        v = v.astype(np.float64)
        own = self._rest(v)
        far = (v * v).sum(1)[:, None] + (objects * objects).sum(1) - 2.0 * (v @ objects.T) + (own[:, None] - rest) ** 2
        block = far.argmin(1)
        d = v - objects[block]
        return block.astype(np.int32), np.sqrt((d * d).sum(1) + (own - rest[block]) ** 2)

    def allowed(self, query: np.ndarray, radii: dict[int, float], floor: int | None) -> list[int]:
        """The blocks that may hold a row of score floor or more."""
        blocks = sorted(radii)
        if floor is None or len(query) not in self.by_length:
            return blocks
        objects, _ = self.by_length[len(query)]
        q = query.astype(np.float64)
        base = float(q @ q) + self.top
        d = np.sqrt(np.maximum(base - 2.0 * (objects[blocks] @ q), 0))
        radius = np.array([radii[b] for b in blocks])
        return np.array(blocks)[d - radius <= distance(base, floor) + _SLACK].tolist()


_ASKED = "query_id bigint, vec_id bigint, score bigint"
_ROWS = "dim int, block int, gap double, asked boolean, row bigint, vec_id bigint, v array<bigint>"


def _vectors(batch: pa.RecordBatch, column: int, at: int, n: int, dim: int) -> np.ndarray:
    return batch.column(column).slice(at, n).flatten().to_numpy(zero_copy_only=False).reshape(n, dim)


def _cuts(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Runs of equal rows."""
    edge = np.flatnonzero(np.any([np.diff(c) != 0 for c in columns], axis=0)) + 1
    return [(a, b) for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(columns[0])], strict=True) if a < b]


def _assigned(rows: DataFrame, upper: Upper) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(upper)  # at most PIVOTS vectors

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            dim = batch.column(0).to_numpy(zero_copy_only=False)
            block, gap = np.empty(len(dim), np.int32), np.empty(len(dim))
            for a, b in _cuts(dim):
                block[a:b], gap[a:b] = shared.value.nearest(_vectors(batch, 4, a, b - a, int(dim[a])))
            cols = [batch.column(0), pa.array(block), pa.array(gap), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in _ROWS.split(", ")])

    return rows.mapInArrow(run, _ROWS)


def _answers(data: DataFrame, asked: DataFrame, top: int, k: int, tasks: int, counter: Accumulator | None) -> DataFrame:
    """_ASKED of the queries in the parts of blocks that they were sent to, k each."""
    key = ["dim", "block", "part"]
    data = data.select(*key, F.lit(0).alias("kind"), "vec_id", F.lit(None).cast("bigint").alias("floor"), "v")
    asked = asked.select(*key, F.lit(1).alias("kind"), "vec_id", "floor", "v")
    dealt = data.union(asked).repartition(tasks, *key).sortWithinPartitions(*key, "kind")

    def run(batches: Iterator[pa.RecordBatch]):
        here, ids, parts, tree = None, [], [], None
        for batch in batches:
            dim, block, part, kind, vec = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            out: list[tuple[np.ndarray, ...]] = []
            for a, b in _cuts(dim, block, part, kind):
                some = _vectors(batch, 6, a, b - a, int(dim[a]))
                if here != (dim[a], block[a], part[a]):
                    here, ids, parts, tree = (dim[a], block[a], part[a]), [], [], None
                if kind[a] == 0:
                    ids.append(vec[a:b])
                    parts.append(some)
                    continue
                if tree is None:
                    tree = MTree(np.concatenate(ids) if ids else np.empty(0, np.int64), np.concatenate(parts) if parts else some[:0], top)
                floors = batch.column(5).slice(a, b - a).to_pylist()
                for at in range(0, b - a, TOGETHER):
                    to, before = min(at + TOGETHER, b - a), tree.compared
                    own = vec[a + at : a + to]
                    scores, found = tree.search_all(some[at:to], own.tolist(), k, floors[at:to])
                    there = scores > NONE
                    out.append((np.repeat(own, k)[there.ravel()], found[there], scores[there]))
                    if counter is not None:
                        counter.add(tree.compared - before)
            cols = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.empty(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

    return dealt.mapInArrow(run, _ASKED)


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, counter: Accumulator | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest integer inner product of each query.

    counter adds up the objects of trees that queries are compared with, if given.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, scale)
    largest = F.aggregate("v", F.lit(0).cast("double"), lambda s, c: s + c.cast("double") * c.cast("double"))
    wide = F.array_max(F.transform("v", F.abs))
    n, top, widest = rows.agg(F.count(F.lit(1)), F.max(largest), F.max(wide)).head()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if widest >= 2**31:
        raise ValueError(f"a scaled component is {widest}; scores would not fit 64 bits")
    top = int(top)
    pivots = min(PIVOTS, max(LEAST_BLOCKS, -(-n // BLOCK_ROWS)))
    chosen = rows.select("v").orderBy(F.xxhash64("v"), "vec_id").limit(pivots).collect()  # at most PIVOTS vectors
    upper = Upper([r["v"] for r in chosen], top)
    numbered = rows.select(F.size("v").alias("dim"), F.coalesce(is_query, F.lit(False)).alias("asked"), F.monotonically_increasing_id().alias("row"), "vec_id", "v")
    rows = common.materialize(_assigned(numbered, upper), "vectors")
    # a row for each pivot, and one for each length without
    sizes = rows.groupBy("dim", "block").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius")).collect()
    parts = [(r["dim"], r["block"], -(-r["n"] // max(1, min(BLOCK_ROWS, PART_BYTES // (8 * r["dim"]))))) for r in sizes]
    blocks = spark.createDataFrame(parts, "dim int, block int, parts int")
    tasks = 4 * sum(p[2] for p in parts)
    radii: dict[int, dict[int, float]] = {}
    for r in sizes:
        radii.setdefault(r["dim"], {})[r["block"]] = r["radius"]
    rows = rows.join(F.broadcast(blocks), ["dim", "block"])  # at most PIVOTS rows of three numbers
    data = rows.withColumn("part", F.pmod("row", F.col("parts")).cast("int"))
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    asked = rows.where("asked").select("dim", "block", "parts", "vec_id", F.lit(None).cast("bigint").alias("floor"), "v")
    first = _answers(data, asked.select("*", every_part), top, k, tasks, counter)
    first = common.materialize(_best(first, k), "first-answers")
    floors = first.where(F.col("rank") == k).select("vec_id", "query_id", "score").select(F.col("query_id").alias("vec_id"), F.col("score").alias("known"))
    shared = spark.sparkContext.broadcast((upper, radii))

    def visits(batches: Iterator[pa.RecordBatch]):
        upper, radii = shared.value
        for batch in batches:
            dim, own, floor = (batch.column(i).to_pylist() for i in (0, 1, 3))
            found = [
                [b for b in upper.allowed(_vectors(batch, 4, i, 1, d)[0], radii[d], f) if b != o]
                for i, (d, o, f) in enumerate(zip(dim, own, floor, strict=True))
            ]
            cols = [batch.column(0), pa.array(found, pa.list_(pa.int32())), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(cols, ["dim", "blocks", "vec_id", "floor", "v"])

    asked = asked.join(floors, "vec_id", "left").select("dim", "block", "vec_id", F.col("known").alias("floor"), "v")
    sent = asked.mapInArrow(visits, "dim int, blocks array<int>, vec_id bigint, floor bigint, v array<bigint>")
    sent = sent.select("dim", F.explode("blocks").alias("block"), "vec_id", "floor", "v").join(F.broadcast(blocks), ["dim", "block"])
    second = _answers(data, sent.select("*", every_part), top, k, tasks, counter)
    return _best(first.drop("rank").unionByName(second), k).select("query_id", "rank", "vec_id", "score")
