import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelweave.llm import metric_search as M
from voxelweave.llm.oracle import ORACLE

SCHEMA = "vec_id bigint, embedding array<float>, Dim int, SCORE int"


def brute(rows, every, k):
    good = [(i, [math.floor(256.0 * c) for c in v]) for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for q, x in good:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in good if i != q and len(y) == len(x))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [1, 40, 1000])
def test_equals_brute_force(spark, spread):
    rng = np.random.default_rng(spread)
    centres = rng.normal(size=(5, 8))
    v = np.float32(centres[rng.integers(0, 5, 700)] + rng.normal(size=(700, 8)) / spread)
    rows = [(int(i), [float(c) for c in x]) for i, x in enumerate(v)] + [(700 + i, [float(c) for c in v[i % 3]]) for i in range(60)]
    rows += [(800, None), (810, []), (820, [1.0, None]), (830, [math.nan] * 8), (840, [math.inf] * 8), (None, rows[0][1]), (850, [1.0, 2.0]), (851, [3.0, -2.0]), (860, [0.0] * 8)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    out = M.top_k(df, F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted(map(tuple, out)) == brute(rows, 10, 5)


def test_repeated_ids_count_as_often_as_in_the_sql(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(c) for c in x]) for i, x in enumerate(np.float32(rng.normal(size=(300, 4))))]
    rows += [(1, [9.0, 9.0, 9.0, 9.0])] * 2 + [(2, [-9.0, 9.0, -9.0, 9.0])] * 7  # more copies of a best match than places
    rows += [rows[20]] * 12 + [rows[30], (30, [-1.0, 2.0, 0.5, 0.0])]  # repeated queries: the same vector, and another one
    rows += [(40, [50.0, 50.0, 50.0, 50.0])] * 12  # own rows that score above all others
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["vec_id", "embedding"])
    con.execute("create table embeddings as select vec_id::bigint as vec_id, embedding::float[] as embedding from frame")
    want = con.sql(ORACLE["op5_metric_search"].replace("% 50", "% 10")).fetchall()
    out = M.top_k(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA), F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted(map(tuple, out)) == sorted(want)


def test_own_rows_take_no_place_in_a_leaf():
    v = np.array([[9]] * 12 + [[k] for k in range(8)])
    tree = M.MTree(np.array([0] * 12 + list(range(1, 9))), v, 81)
    assert tree.search(v[0], 0, 5) == [(9 * k, k + 1) for k in (7, 6, 5, 4, 3)]


def test_blocks_of_small_tables_have_trees(spark):
    rng = np.random.default_rng(11)
    v = np.float32((rng.normal(size=(30, 1, 4)) * 9 + rng.normal(size=(30, 80, 4))).reshape(-1, 4))
    rows = [(int(i), [float(c) for c in x]) for i, x in enumerate(v)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    assert sorted(map(tuple, M.top_k(df, F.col("vec_id") % 50 == 0, 5).collect())) == brute(rows, 50, 5)
    n = len(rows) // M.LEAST_BLOCKS
    whole = np.floor(256 * v[rng.permutation(len(v))[:n]].astype(float)).astype(np.int64)
    tree = M.MTree(np.arange(n), whole, int((whole * whole).sum(1).max()))
    assert len(tree.pages) > 2
    for k in range(n):
        tree.search(whole[k], None, 5)
    assert tree.compared < 0.75 * n * n


def levels(tree):
    def depth(page):
        leaf, _, _, _, children = tree.pages[page]
        return 1 if leaf else 1 + max(depth(c) for c in children.tolist())

    return depth(tree.root)


def test_blocks_of_the_given_table_have_several_levels(spark):
    rows = M.quantised(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")).collect()
    v = np.array([r.v for r in rows])
    top = int((v * v).sum(1).max())
    block, gap = M.Upper([r.v for r in rows[: M.LEAST_BLOCKS]], top).nearest(v)
    assert len(np.unique(block)) > 6 and np.isfinite(gap).all()
    deep = [levels(M.MTree(np.arange((block == b).sum()), v[block == b], top)) for b in np.unique(block) if (block == b).sum() > 4 * M.PAGE]
    assert deep and min(deep) >= 3


def test_queries_skip_blocks_and_pages_of_clustered_rows(spark):
    rng = np.random.default_rng(5)
    v = np.float32((rng.normal(size=(40, 1, 6)) * 9 + rng.normal(size=(40, 100, 6)) / 4).reshape(-1, 6))
    rows = [(int(i), [float(c) for c in x]) for i, x in enumerate(rng.permutation(v))]
    counter = spark.sparkContext.accumulator(0)
    out = M.top_k(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA), F.col("vec_id") % 50 == 0, 5, counter=counter).collect()
    assert sorted(map(tuple, out)) == brute(rows, 50, 5)
    assert 0 < counter.value < 0.5 * 80 * len(rows)


def test_one_vector_that_most_rows_share(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, -2.0, 3.0]) for i in range(300)] + [(300 + i, [float(c) for c in np.float32(rng.normal(size=3))]) for i in range(200)]
    out = M.top_k(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA), F.col("vec_id") % 20 == 0, 5).collect()
    assert sorted(map(tuple, out)) == brute(rows, 20, 5)


def test_large_components(spark):
    rows = [(i, [float(np.float32((-1) ** i * 3e6 / (i + 1))), 1e6]) for i in range(40)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    assert sorted(map(tuple, M.top_k(df, F.col("vec_id") % 10 == 0, 5).collect())) == brute(rows, 10, 5)
    with pytest.raises(ValueError, match="64 bits"):
        M.top_k(spark.createDataFrame([(1, [1e30], 0, 0)], SCHEMA), F.lit(True))


def test_tree_skips_pages_of_clustered_rows():
    rng = np.random.default_rng(7)
    v = (rng.normal(size=(40, 1, 4)) * 1000 + rng.normal(size=(40, 500, 4))).reshape(-1, 4).astype(np.int64)
    tree = M.MTree(np.arange(len(v)), v, int((v * v).sum(1).max()))
    order = np.argsort(-(v @ v[3]), kind="stable")
    scores = (v @ v[3])[order][:6]
    assert [s for s, _ in tree.search(v[3], None, 6)] == scores.tolist()
    assert tree.compared < len(v) / 2


def test_empty_and_few(spark):
    assert M.top_k(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    assert M.top_k(spark.createDataFrame([(0, [1.0], 0, 0)], SCHEMA), F.lit(True)).count() == 0
