import math

import numpy as np
import pytest
import zstandard

from voxelweave.llm import compression as C
from voxelweave.llm import linear

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, Quality int"
LABELS = "doc_id bigint, quality int, Score int"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = C.score(docs, C.fit(docs, labels)).join(labels, "doc_id").toPandas()
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.3)).all()
    held = rows[rows.held_out]
    assert (held.predicted == held.quality).mean() >= 0.93


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    good = [" ".join(rng.choice(["the", "quiet", "river", "runs", "past", "old", "mills"], 60)) for _ in range(60)]
    bad = ["!!! BUY $$$ NOW ### " * 12 + str(i) for i in range(60)]
    docs = [*enumerate(good), *((100 + i, t) for i, t in enumerate(bad)), (900, None), (901, ""), (None, good[0]), (902, "x" * 300_000)]
    df = spark.createDataFrame([(*d, 0) for d in docs], DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 0, 0) for i in range(60)] + [(3, None, 0), (4, 9, 0), (None, 1, 0)], LABELS)
    rows = {r.doc_id: r for r in C.score(df, C.fit(df, labels)).collect()}
    assert len(rows) == len(docs) and rows[900].score == rows[901].score and rows[None].predicted == 1
    assert sum(rows[i].predicted for i in range(60)) >= 58 and sum(rows[100 + i].predicted for i in range(60)) <= 2


def plain_features(text, good, bad):
    """The features from the description alone: sizes of each 2 kB block under both dictionaries, and what is made of them."""
    data = (text or "").encode()
    parts = [data[i : i + 2048] for i in range(0, len(data), 2048)] or [b""]

    def size(part, dictionary):
        kind = zstandard.DICT_TYPE_AUTO if dictionary.startswith(bytes([0x37, 0xA4, 0x30, 0xEC])) else zstandard.DICT_TYPE_RAWCONTENT
        return len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=kind), write_content_size=False).compress(part))

    sizes = [(size(p, good), size(p, bad), len(p)) for p in parts]
    shares = [(b - g) / max(n, 32) for g, b, n in sizes]
    g, b, n = (sum(s[k] for s in sizes) for k in range(3))
    n = max(n, 32)
    x = [(b - g) / n, min(shares), max(shares), g / n, b / n, math.log(n)]
    return x + [v * v for v in x] + [x[0] * v for v in x[1:]]


def test_scores_equal_a_plain_recomputation(spark):
    docs, labels = (spark.read.parquet(f"{DATA.replace('0.01', '0.001')}/{t}.parquet") for t in ("documents", "labels"))
    model = C.fit(docs, labels)
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.score for r in C.score(docs, model).collect()}
    for d, text in list(rows.items())[:60]:
        x = np.array(plain_features(text, model.good, model.bad))
        assert x == pytest.approx(C.features(text, model.good, model.bad), abs=1e-12)
        assert got[d] == pytest.approx(model.fit(x[None])[0], abs=1e-9)


def test_repeated_rows_and_labels(spark):
    docs = [(i, f"the quiet river runs past mill {i} and on to the sea", 0) for i in range(30)] + [(100 + i, f"$$$ !!! win ### {i} $$$", 0) for i in range(30)]
    df = spark.createDataFrame(docs + docs[:5] + [(7, "another text of a known id", 0), (None, docs[0][1], 0), (None, docs[0][1], 0)], DOCS)
    labels = [(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(30)]
    once, twice = (C.score(df, C.fit(df, spark.createDataFrame(rows, LABELS))).collect() for rows in (labels, labels * 2))
    assert sorted(map(str, once)) == sorted(map(str, twice)) and len(once) == len(docs) + 8
    by = {}
    for r in once:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[0]) == 2 and by[0][0] == by[0][1] and len(by[7]) == 2
    assert [r.held_out for r in by[None]] == [False, False] and by[None][0].score == by[0][0].score


def test_texts_with_large_ids_enter_the_dictionary():
    rng = np.random.default_rng(2)
    first = [rng.integers(97, 123, 100_000, np.uint8).tobytes() for _ in range(450)]  # 22,050 blocks
    late = [b"".join(b"the quiet river runs past old mills %d " % k for k in range(i, i + 2000)) for i in range(0, 50_000, 250)]
    parts = [b for t in first + late for b in C.blocks(t)]
    some = C.chosen(parts)
    assert len(some) == C.PARTS and C.chosen(parts[:50]) == parts[:50]
    share = sum(b"quiet river" in b for b in some) / len(some)
    assert abs(share - sum(b"quiet river" in b for b in parts) / len(parts)) < 0.02
    assert b"quiet river" in C.dictionary(first + late)


def test_one_class_no_labels_no_rows(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], DOCS)
    one = spark.createDataFrame([(1, 0, 0), (2, 0, 0)], LABELS)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in C.score(df, C.fit(df, one)).collect()} == {0.0}
    assert {r.score for r in C.score(df, C.fit(df, none)).collect()} == {0.5}
    empty = spark.createDataFrame([], DOCS)
    assert C.score(empty, C.fit(empty, none)).count() == 0


def test_logistic_learns_a_line():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    fit = linear.fit(x, y)
    assert abs(fit(np.array([[0.0, 0.0]]))[0] - 1 / (1 + np.exp(-0.5))) < 0.05
    assert linear.fit(np.empty((0, 2)), np.empty(0))(x[:1])[0] == 0.5
