import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelweave.llm import toxicity as T

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, Label int, SCORE double"
LABELS = "doc_id bigint, toxic int, TEXT string"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    return T.score(docs, T.fit(docs, labels)).join(labels, "doc_id").toPandas(), docs.count()


def test_held_out_accuracy(scored):
    rows, _ = scored
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all()
    assert (rows.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in rows.doc_id]).all()
    held = rows[rows.held_out]
    assert (held.predicted == held.toxic).mean() >= 0.9
    assert rows[rows.toxic == 0].predicted.mean() < 0.02


def test_held_out_recall_and_precision(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = T.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    both = ((held.predicted == 1) & (held.toxic == 1)).sum()
    # some labels are wrong: a share of the toxic ones has no such word
    assert held.toxic.sum() > 80 and both / held.toxic.sum() >= 0.88 and both / held.predicted.sum() >= 0.95


def test_scores_equal_a_plain_recomputation(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model, measured = T.learn(docs, labels)
    rows = T.classify(docs, labels).orderBy("doc_id").toPandas()
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    assert np.allclose(rows.score, model(texts), atol=1e-9)
    for text, r in zip(texts[:200], measured.orderBy("doc_id").limit(200).collect(), strict=True):
        assert T.Lexicons(model.lexicons.starts, model.lexicons.words).features(text) == (r["_bits"], r["_x"])


def plain_features(text, starts, words):
    """Votes and counts from the description, one word after the other."""
    text = text or ""
    low = re.findall(r"[^\W\d_]+", text.lower())
    n = len(low)
    lists = [lambda w: w in T.INSULTS, *((lambda w, k=k: len(w) >= k and w[:k] in starts[k]) for k in (4, 5, 6)), lambda w: w in words]
    sums = [sum(map(f, low)) for f in lists]
    hit = [any(f(w) for f in lists) for w in low]
    every = sum(hit)
    upper = sum("A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" for c in text) / (sum(map(len, low)) or 1)
    marks = text.count("!") / max(n, 1)
    near = any(h and any(w in T.ADDRESS for w in low[max(0, i - 4) : i + 4]) for i, h in enumerate(hit))
    several = len({w for w in low if w in T.INSULTS}) > 1
    votes = [sums[0] > 0, several, *(s > 0 for s in sums[1:]), every > 1 and every >= 0.004 * n, upper > 0.3, marks > 0.1, near]
    x = [*(math.log(1 + s) for s in sums), *(float(s > 0) for s in sums), float(every > 0), float(every > 1), math.log(1 + every), every / max(n, 10), upper, min(marks, 2.0), float(near)]
    return sum(2**i for i, v in enumerate(votes) if v), x


def test_features_equal_a_plain_recomputation(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    model, measured = T.learn(docs, labels)
    known = {r.doc_id: (r["_bits"], list(r["_x"])) for r in measured.collect()}
    lexicons = model.lexicons
    for r in docs.collect():
        bits, x = plain_features(r.text, lexicons.starts, lexicons.words)
        assert known[r.doc_id][0] == bits and known[r.doc_id][1] == pytest.approx(x, abs=1e-12)


def test_one_step_of_the_label_model_by_hand():
    """Two voters without pairs: after EM the votes of each are independent given the label, so its posterior is Bayes' rule."""
    rng = np.random.default_rng(8)
    n = 40_000
    y = rng.random(n) < 0.4
    votes = np.array([np.where(y, rng.random(n) < p, rng.random(n) < q) for p, q in ((0.8, 0.1), (0.6, 0.2), (0.7, 0.05))])
    bits = (votes << np.arange(3)[:, None]).sum(0)
    counts = np.zeros((3, 8))
    np.add.at(counts, (np.where(np.arange(n) % 2 == 0, y, 2).astype(int), bits), 1)
    model = T.LabelModel(counts, voters=3, pairs=0)
    for b in range(8):
        like = [pi * math.prod(p[i] if b >> i & 1 else 1 - p[i] for i in range(3)) for pi, p in ((0.4, (0.8, 0.6, 0.7)), (0.6, (0.1, 0.2, 0.05)))]
        assert model.posterior[b] == pytest.approx(like[0] / sum(like), abs=0.03)


def test_label_model_finds_accuracies_and_a_correlated_pair():
    rng = np.random.default_rng(3)
    n, right = 60_000, [0.9, 0.8, 0.75, 0.85, 0.6]
    y = rng.random(n) < 0.3
    votes = np.array([np.where(rng.random(n) < a, y, ~y) for a in right])
    votes = np.vstack([votes, np.where(rng.random(n) < 0.95, votes[4], ~votes[4])])
    bits = (votes << np.arange(6)[:, None]).sum(0)
    counts = np.zeros((3, 64))
    np.add.at(counts, (np.where(np.arange(n) % 20 == 0, y, 2).astype(int), bits), 1)
    model = T.LabelModel(counts, voters=6, pairs=1)
    assert model.pairs == [(4, 5)]
    assert np.allclose(model.accuracy[:4], right[:4], atol=0.03)
    assert ((model.posterior[bits] > 0.5) == y).mean() > 0.9


def test_odd_rows(spark):
    docs = [(i, f"clean words number {i} here", 0, 0.0) for i in range(20)] + [(100 + i, f"you are a stupid idiot and trash {i}", 0, 0.0) for i in range(20)]
    docs += [(1000, None, 1, 1.0), (1001, "", 1, 1.0), (None, "you idiot, you moron", 0, 0.0), (0, "repeated id", 0, 0.0), (1002, "word " * 100_000, 0, None)]
    df = spark.createDataFrame(docs, DOCS)
    labels = spark.createDataFrame([(i, 0, "x") for i in range(20)] + [(100 + i, 1, "x") for i in range(20)] + [(5, 7, ""), (None, 1, ""), (77777, 1, "")], LABELS)
    out = T.score(df, T.fit(df, labels))
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(docs) and rows[1000].score == rows[1001].score and rows[1000].predicted == 0
    assert rows[105].predicted == 1 and rows[None].predicted == 1 and rows[None].held_out is False and rows[3].predicted == 0
    kept = T.keep_clean(df, labels)
    assert kept.columns == df.columns and kept.where(F.col("doc_id").between(100, 119)).count() == 0 and kept.where("doc_id < 20 or doc_id >= 1000").count() == 24


def test_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "you are an idiot, a moron and scum", 0, 0.0), (2, "a fine day", 0, 0.0)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert {r.doc_id: r.predicted for r in T.score(df, T.fit(df, none)).collect()} == {1: 1, 2: 0}
    empty = spark.createDataFrame([], DOCS)
    assert T.score(empty, T.fit(empty, none)).count() == 0
