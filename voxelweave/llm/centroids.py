"""Centroid clustering of integer vectors, with partial-distance search.

Every round assigns all vectors and replaces the centroids by the floor of their vectors' means. A vector's
squared distance from a centroid is added up over blocks of dimensions, those of the highest variance first; a
centroid is left once its partial sum is strictly above the best full distance so far, so only survivors
see every dimension. What is left out could not have won, nor tied: the result is that of full distances.

Vectors stay where they are: a round is one pass, which sends a row of counts and sums for each task and centroid through
a shuffle, spread by dimension. The driver holds the centroids alone (k rows of dim integers).

Defined results: vectors of another length, or with null or non-finite components, are not kept. Rows are counted as
often as they are there, and rows of a repeated id are different vectors; of rows with equal hashes the one with the
smaller components starts first. A row without an id is kept and assigned, but starts no centroid. With fewer vectors than k each
starts one (equal rows give equal centroids; the later ones stay empty). Ties go to the smaller number. An
empty table gives no rows; other columns, whatever their names, are ignored. Components beyond 2^27 after
scaling are refused with an error, since distances would not fit 64 bits; so are sums of distances beyond them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

DIM, SCALE, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, "1"
#: Dimensions added up between two looks at the best distance.
BLOCK = 8
LARGEST = 1 << 27
#: Vectors that are compared at once: bounds the working arrays, whatever the batch.
STEP = 4096


def nearest(v: np.ndarray, centroids: np.ndarray, order: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, its squared distance) of each row of v, and the terms that were added up.

    order has the dimensions, those to be added up first in front.
    """
    v, centroids = v[:, order], centroids[:, order]
    best, winner, terms = np.full(len(v), np.iinfo(np.int64).max), np.zeros(len(v), np.int32), 0
    for number, c in enumerate(centroids):
        alive, partial = np.arange(len(v)), np.zeros(len(v), np.int64)
        for at in range(0, v.shape[1], block):
            d = v[alive, at : at + block] - c[at : at + block]
            terms += d.size
            partial += np.einsum("ij,ij->i", d, d)
            stays = partial <= best[alive]
            if not stays.all():
                alive, partial = alive[stays], partial[stays]
        closer = partial < best[alive]  # a tie stays with the smaller number
        best[alive[closer]], winner[alive[closer]] = partial[closer], number
    return winner, best, terms


def kept(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the scaled components rounded down, of the vectors that take part."""
    rows = common.only(vectors, "vec_id", "embedding").where(F.size("embedding") == dim)
    rows = rows.where(F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))))
    scaled = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    low, high = (f(F.transform("embedding", lambda c: c.cast("double") * scale)) for f in (F.array_min, F.array_max))
    fits = (low >= -LARGEST) & (high < LARGEST)
    wide = F.raise_error(F.lit(f"a scaled component is beyond {LARGEST}")).cast("array<bigint>")
    return rows.select(F.col("vec_id").cast("bigint"), F.when(fits, scaled).otherwise(wide).cast("array<int>").alias("v"))


def _matrix(batch: pa.RecordBatch, column: int, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    for at in range(0, len(flat), STEP):
        yield at, flat[at : at + STEP].astype(np.int64)


def _order(rows: DataFrame, dim: int) -> np.ndarray:
    """Dimensions by falling variance over all vectors, exact in integers."""
    x = F.col("x").cast("decimal(20)")
    found = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q")).collect()  # dim rows
    spread = {r["d"]: int(r["n"]) * int(r["q"]) - int(r["s"]) ** 2 for r in found}
    return np.array(sorted(range(dim), key=lambda d: (-spread[d], d)))


def _first(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest hashes."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256).alias("mark")
    found = rows.where("vec_id is not null").select(mark, "v").orderBy("mark", "v").limit(k).collect()  # k vectors
    return np.array([r["v"] for r in found], np.int64)


def _moved(rows: DataFrame, centroids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]):
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            for _, v in _matrix(batch, 0, dim):
                winner, _, _ = nearest(v, centroids, order)
                count += np.bincount(winner, minlength=k)
                by = np.argsort(winner, kind="stable")
                there, first = np.unique(winner[by], return_index=True)
                total[there] += np.add.reduceat(v[by], first)
        some = np.flatnonzero(count)
        cols = [pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(cols, ["cluster", "n", "total"])

    parts = rows.select("v").mapInArrow(run, "cluster int, n bigint, total array<bigint>")
    sums = parts.select("cluster", "n", F.posexplode("total").alias("d", "x")).groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(30)")).alias("x"))
    out = centroids.copy()
    for r in sums.collect():  # k * dim numbers
        out[r["cluster"], r["d"]] = int(r["x"]) // r["n"]
    return out


def _assigned(rows: DataFrame, centroids: np.ndarray, order: np.ndarray, counter: Accumulator | None) -> DataFrame:
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at, v in _matrix(batch, 1, dim):
                winner, distance, terms = nearest(v, centroids, order)
                if counter is not None:
                    counter.add(terms)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(v)), pa.array(winner), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = SEED, counter: Accumulator | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector.

    counter adds up the terms of distances that the last assignment needed, if given (in all there are
    k * dim for each vector).
    """
    spark = vectors.sparkSession
    rows = common.materialize(kept(vectors, dim, scale), "kept-vectors")
    centroids = _first(rows, k, seed)
    if not len(centroids):
        if not rows.isEmpty():
            raise ValueError("no vector has an id, so none can start a centroid")
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    order = _order(rows, dim)
    for _ in range(rounds):
        centroids = _moved(rows, centroids, order)
    found = common.materialize(_assigned(rows, centroids, order, counter), "clusters")
    by_cluster = {r[0]: r[1] for r in found.groupBy("cluster").agg(F.sum("distance")).collect()}  # k rows
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = [(c, by_cluster[c], sum(by_cluster.values()), marks[c]) for c in sorted(by_cluster)]
    about = spark.createDataFrame(table, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
