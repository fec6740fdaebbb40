"""Toxicity by weak supervision.

Many voters look at a text: a fixed lexicon, lexicons of word starts and words induced from
labelled rows, and patterns (shouting, marks, direct address, density of hits). A generative label
model over all documents' votes estimates how accurate each voter is and which voters go together
beyond the label (a log-linear model with pair terms, fitted by EM; labelled training rows keep
their label in the E step). A linear classifier on hit counts is then trained on the posterior
labels and scores every whole text.

Votes and counts of all documents are worked out once, whole texts, and written as a table; the vote
patterns are counted in a distributed aggregate of at most 3 * 2^len(VOTERS) rows. Lexicons and
classifier are fitted on a bounded sample of labelled rows: at most ``TOXIC_ROWS`` and ``CLEAN_ROWS``
distinct texts, none above ``sampling.MAX_CHARS``; an induced lexicon has at most ``MAX_ENTRIES``
entries. The label model's posteriors of at most ``UNLABELLED_ROWS`` documents without a label (by a
hash of the id, none held out) train the classifier too, with ``UNLABELLED_WEIGHT`` in all.

Defined results: a null text is scored as an empty one; labels other than 0 and 1, or without a
document, are ignored; without any labels the fixed lexicon and the patterns vote alone; each input
row gives one row, repeated ones and those without an id too; an empty table gives none; other
columns, whatever their names, are ignored by the scores and kept by the filters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from . import common, linear, sampling

TOXIC_ROWS, CLEAN_ROWS, MAX_ENTRIES = 4000, 12_000, 2000
UNLABELLED_ROWS, UNLABELLED_WEIGHT = 8000, 0.25
THRESHOLD = 0.5
#: Common insults.
INSULTS = """
    asshole bastard bitch braindead clown coward creep cretin cunt degenerate disgusting dumbass dumb dimwit
    fool filth freak garbage halfwit idiot idiotic imbecile jackass jerk lunatic loser losers lowlife maggot moron
    moronic numbskull parasite pathetic pig psycho pervert retard retarded scum scumbag shithead slut simpleton
    stupid sucker swine trash twat vermin whore weasel wimp worthless wretch
""".split()
ADDRESS = frozenset("you your youre u thou tu te toi vous du dich ihr sie usted ustedes vosotros".split())
STARTS = (4, 5, 6)
VOTERS = ["insult", "insults", "start4", "start5", "start6", "word", "dense", "shouting", "marks", "addressed"]
_WORD = re.compile(r"[^\W\d_]+")


class Lexicons:
    def __init__(self, starts: dict[int, frozenset[str]], words: frozenset[str]):
        self.insults, self.starts, self.words = frozenset(INSULTS), starts, words
        entries = [*INSULTS, *words, *(s for k in starts for s in starts[k])]
        self.gate = frozenset(e[:3] for e in entries)

    def features(self, text: str | None) -> tuple[int, list[float]]:
        """The votes as bits, and the counts for the classifier."""
        text = text or ""
        words = _WORD.findall(text.lower())
        n = len(words)
        counts = Counter(words)
        gate = self.gate
        some = [w for w in counts if w[:3] in gate]
        hits = [[w for w in some if w in self.insults], *([w for w in some if len(w) >= k and w[:k] in self.starts[k]] for k in STARTS), [w for w in some if w in self.words]]
        sums = [sum(counts[w] for w in h) for h in hits]
        every = sum(counts[w] for w in {w for h in hits for w in h})
        letters = sum(map(len, words)) or 1
        upper = sum(map(len, _UPPER.findall(text))) / letters
        marks = text.count("!") / max(n, 1)
        flat = {w for h in hits for w in h}
        addressed = bool(flat) and any(w in flat and ADDRESS.intersection(words[max(0, i - 4) : i + 4]) for i, w in enumerate(words))
        votes = [sums[0] > 0, len(hits[0]) > 1, sums[1] > 0, sums[2] > 0, sums[3] > 0, sums[4] > 0, every > 1 and every >= 0.004 * n, upper > 0.3, marks > 0.1, addressed]
        bits = sum(1 << i for i, v in enumerate(votes) if v)
        x = [*(np.log1p(s) for s in sums), *(float(len(h) > 0) for h in hits), float(every > 0), float(every > 1), np.log1p(every), every / max(n, 10), upper, min(marks, 2.0), float(addressed)]
        return bits, x


_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")


def induce(sample: DataFrame, most: int = MAX_ENTRIES, odds: float = 3.0, chance: float = 1e-5) -> Lexicons:
    """Word starts and words whose document frequency among toxic texts is exp(odds) times that among others.

    An entry that says nothing about the label would be in its toxic texts alone with less than the given chance.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        seen = [Counter(), Counter()]
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = set(_WORD.findall(text.lower()))
                found = {(0, w) for w in words if len(w) >= 4}
                for k in STARTS:
                    found |= {(k, w[:k]) for w in words if len(w) >= k}
                seen[label].update(found)
                if len(seen[0]) + len(seen[1]) > 500_000:
                    yield _counted(seen)
                    seen = [Counter(), Counter()]
        yield _counted(seen)

    sizes = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    counts = sample.select("label", "text").mapInArrow(run, "kind int, entry string, toxic bigint, clean bigint").groupBy("kind", "entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    lift = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    share = -np.log((toxic + 0.5) / (toxic + clean + 1.0))
    good = counts.where(F.col("toxic") * float(share) >= float(-np.log(chance)) + 3.0 * F.col("clean")).withColumn("lift", lift).where(F.col("lift") >= odds)
    rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("lift"), F.desc("toxic"), "entry"))
    rows = good.withColumn("rank", rank).where(F.col("rank") <= most).select("kind", "entry").collect()  # at most 4 * most
    found = {kind: frozenset(r["entry"] for r in rows if r["kind"] == kind) for kind in (0, *STARTS)}
    return Lexicons({k: found[k] for k in STARTS}, found[0])


def _counted(seen: list[Counter]) -> pa.RecordBatch:
    keys = list(seen[0].keys() | seen[1].keys())
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int32()), pa.array([e for _, e in keys], pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())], ["kind", "entry", "toxic", "clean"])


class LabelModel:
    """p(votes, y) = exp(a y + sum_j (b_j + c_j y) vote_j + sum_jk d_jk vote_j vote_k) / Z.

    The pairs are those whose votes, given the current posterior, correlate most. All 2^(voters + 1)
    states are summed, so the fit is exact. c_j tells a voter's accuracy, d_jk a correlation.
    """

    def __init__(self, counts: np.ndarray, voters: int = len(VOTERS), pairs: int = 12, rounds: int = 25):
        """counts[label, bits]: documents without a label (2), or with label 0 or 1."""
        self.voters = voters
        bits = (np.arange(1 << voters)[:, None] >> np.arange(voters)) & 1
        self.bits = bits.astype(float)
        total = counts.sum()
        self.posterior = np.clip((self.bits @ np.array([1.0] * min(7, voters) + [0.0] * max(0, voters - 7))) / min(7, voters), 0.02, 0.98)
        if not total:
            self.pairs, self.accuracy = [], np.full(voters, 0.5)
            return
        self.pairs: list[tuple[int, int]] = []
        theta = None
        for r in range(rounds):
            p1 = counts[2] * self.posterior + counts[1]
            p0 = counts[2] * (1 - self.posterior) + counts[0]
            if r == 3:
                self.pairs, theta = self._correlated(p0, p1, pairs), None
            design = self._design()
            target = (np.r_[p0, p1] @ design) / total
            theta = self._match(design, target, theta, total)
            logit = design @ theta
            half = 1 << voters
            self.posterior = 1 / (1 + np.exp(np.clip(logit[:half] - logit[half:], -40, 40)))
        agree = np.r_[p0, p1] @ np.r_[1 - self.bits, self.bits]
        self.accuracy = agree / total

    def _design(self) -> np.ndarray:
        one = np.ones((len(self.bits), 1))
        both = np.array([self.bits[:, i] * self.bits[:, j] for i, j in self.pairs]).T.reshape(len(self.bits), -1)
        rows = [np.c_[y * one, self.bits, y * self.bits, both] for y in (0.0, 1.0)]
        return np.vstack(rows)

    def _correlated(self, p0: np.ndarray, p1: np.ndarray, most: int) -> list[tuple[int, int]]:
        total = 0.0
        for p in (p0, p1):
            n = p.sum() + 1e-9
            mean = p @ self.bits / n
            cov = (self.bits * p[:, None]).T @ self.bits / n - np.outer(mean, mean)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            total = total + np.abs(cov / np.outer(sd, sd)) * n
        order = sorted(combinations(range(self.voters), 2), key=lambda ij: -total[ij])
        return order[:most]

    @staticmethod
    def _match(design: np.ndarray, target: np.ndarray, theta: np.ndarray | None, total: float, steps: int = 12) -> np.ndarray:
        """Newton steps to the parameters with these moments, under a weak prior."""
        theta = np.zeros(design.shape[1]) if theta is None else theta
        ridge = 1e-4 + 1.0 / total
        for _ in range(steps):
            z = design @ theta
            p = np.exp(z - z.max())
            p /= p.sum()
            mean = p @ design
            cov = (design * p[:, None]).T @ design - np.outer(mean, mean)
            step = np.linalg.solve(cov + ridge * np.eye(len(theta)), target - mean - ridge * theta)
            step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
            theta = theta + step
            if np.abs(step).max() < 1e-6:
                break
        return theta


class Model:
    def __init__(self, lexicons: Lexicons, labels: LabelModel, fit: linear.Logistic | linear.Constant):
        self.lexicons, self.labels, self.fit = lexicons, labels, fit

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        return self.fit(np.array([self.lexicons.features(t)[1] for t in texts])) if texts else np.empty(0)


def _measured(docs: DataFrame, lexicons: Lexicons, text: str) -> DataFrame:
    """The columns of docs with votes and counts of each text, kept in the shared folder."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicons)  # at most 4 * MAX_ENTRIES entries
    names, at = [*docs.columns, "_bits", "_x"], docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found = [shared.value.features(t) for t in batch.column(at).to_pylist()]
            cols = [pa.array([b for b, _ in found], pa.int32()), pa.array([x for _, x in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names)

    schema = StructType([*docs.schema.fields, StructField("_bits", IntegerType()), StructField("_x", ArrayType(DoubleType()))])
    return docs.mapInArrow(run, schema)


def _trained(measured: DataFrame, sample: DataFrame, lexicons: Lexicons) -> Model:
    """measured: doc_id, _bits, _x of all documents; sample: doc_id, label."""
    counts = np.zeros((3, 1 << len(VOTERS)))
    for r in measured.groupBy("_bits").count().collect():  # at most 2^voters rows
        counts[2, r["_bits"]] = r["count"]
    ids = F.broadcast(sample)  # bounded
    got = measured.join(ids, "doc_id").select("doc_id", "label", "_bits", "_x").orderBy("doc_id", "label", "_bits", "_x").collect()
    for r in got:
        counts[r["label"], r["_bits"]] += 1
    counts[2] = np.maximum(counts[2] - counts[0] - counts[1], 0)  # the labelled rows are among all documents
    model = LabelModel(counts)
    if not got:  # no labels: the vote patterns themselves, by their counts, are what there is
        return Model(lexicons, model, _by_votes(model))
    free = measured.where(F.col("doc_id").isNotNull() & ~common.held_out(F.col("doc_id"))).join(ids, "doc_id", "left_anti")
    more = free.orderBy(F.xxhash64("doc_id"), "doc_id", "_bits", "_x").limit(UNLABELLED_ROWS).collect()
    x, y = np.array([r["_x"] for r in (*got, *more)]), np.array([model.posterior[r["_bits"]] for r in (*got, *more)])
    weight = np.r_[np.ones(len(got)), np.full(len(more), UNLABELLED_WEIGHT * len(got) / max(len(more), 1))]
    return Model(lexicons, model, linear.fit(x, y, weight))


def learn(docs: DataFrame, labels: DataFrame, name: str = "toxic", rows: tuple[int, int] = (CLEAN_ROWS, TOXIC_ROWS), keep: bool = False) -> tuple[Model, DataFrame]:
    """The fitted model, and a table of all documents with _bits and _x: (doc_id, _bits, _x), or with keep all columns by position."""
    sample = common.materialize(sampling.sample(docs, labels, name, {0: rows[0], 1: rows[1]}), "toxicity-sample")
    lexicons = induce(sample)
    if keep:
        every, place = common.positional(docs)
        measured = common.materialize(_measured(every, lexicons, place["text"]), "toxicity-votes")
        by_id = measured.select(F.col(place["doc_id"]).cast("bigint").alias("doc_id"), "_bits", "_x")
    else:
        every = common.only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text")
        measured = by_id = common.materialize(_measured(every, lexicons, "text").drop("text"), "toxicity-votes")
    return _trained(by_id, sample.select("doc_id", "label"), lexicons), measured


def fit(docs: DataFrame, labels: DataFrame, name: str = "toxic", rows: tuple[int, int] = (CLEAN_ROWS, TOXIC_ROWS)) -> Model:
    return learn(docs, labels, name, rows)[0]


def _by_votes(model: LabelModel) -> linear.Logistic | linear.Constant:
    texts = ["", "a plain sentence of words", *(f"you {w} {w}" for w in INSULTS), *(f"some {w} here" for w in INSULTS)]
    found = [Lexicons({k: frozenset() for k in STARTS}, frozenset()).features(t) for t in texts]
    return linear.fit(np.array([x for _, x in found]), np.array([float(b > 0) for b, _ in found]))


def _score(model: Model) -> Column:
    """The score of a row with _x."""
    fit = model.fit
    if isinstance(fit, linear.Constant):
        return F.lit(float(fit.p))
    z = F.lit(float(fit.w[-1]))
    for i, (mean, sd, w) in enumerate(zip(fit.mean.tolist(), fit.sd.tolist(), fit.w.tolist(), strict=False)):
        z = z + w * F.greatest(F.lit(-20.0), F.least(F.lit(20.0), (F.col("_x")[i] - mean) / sd))
    return 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))


def _scored(measured: DataFrame, model: Model, threshold: float) -> DataFrame:
    rows = measured.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), _score(model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = common.only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text")
    return _scored(_measured(rows, model.lexicons, "text"), model, threshold)


def classify(docs: DataFrame, labels: DataFrame, name: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """As score with a model fitted on the same documents, in one pass over their words."""
    model, measured = learn(docs, labels, name)
    return _scored(measured, model, threshold)


def keep_clean(docs: DataFrame, labels: DataFrame, name: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with scores below threshold, all columns as they were; the model is fitted on them."""
    model, measured = learn(docs, labels, name, keep=True)
    return measured.where(_score(model) < threshold).drop("_bits", "_x").toDF(*docs.columns)
