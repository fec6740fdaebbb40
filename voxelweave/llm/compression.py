"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on good and one on bad labelled texts. A text is cut
into blocks; every block is compressed with both, and the differences of the compressed sizes over
the text's length (in all, and for the least and most good-like block), with the two ratios, become
a calibrated probability through a logistic fit on other labelled rows.

Fitting uses a bounded sample: at most ``ROWS`` distinct texts of each label for the dictionaries
and as many others for the calibration, none above ``sampling.MAX_CHARS``; of their blocks at most
``PARTS`` for each dictionary, the least by a hash of their bytes, so from all texts alike; the
calibration weighs them back to the labels' shares. Scoring covers whole texts of all documents.

Defined results: a null text is scored as an empty one; rows without a label are scored only;
labels other than 0 and 1, or without a document, are ignored; without labels of both kinds every
score is the share of good ones (0.5 without any); each input row gives one row, repeated ones and those
without an id too (never held out, and never learned from); equal texts have equal scores; a repeated label
counts once, and of a text that several labelled rows hold one serves; a text of any length is scored whole,
block by block; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, linear, sampling

ROWS = 1500
DICTIONARY_BYTES = 110_000
BLOCK = 2048
#: Blocks for a dictionary at most; 41 MB.
PARTS = 20_000
LEVEL = 3
THRESHOLD = 0.3


def blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)] or [b""]


def chosen(parts: list[bytes], most: int = PARTS) -> list[bytes]:
    """At most so many of the blocks, by hash, in their order."""
    if len(parts) <= most:
        return parts
    least = sorted(range(len(parts)), key=lambda i: (xxhash.xxh3_64_intdigest(parts[i]), i))[:most]
    return [parts[i] for i in sorted(least)]


def dictionary(texts: list[bytes], most: int = PARTS) -> bytes:
    """A trained dictionary; of too few samples, their last bytes as they are."""
    parts = [b for t in texts for b in blocks(t) if b]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, chosen(parts, most)).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:] or b"\0" * 8


@functools.lru_cache(8)
def compressor(data: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.DICT_TYPE_AUTO if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    d = zstandard.ZstdCompressionDict(data, dict_type=kind)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False)


def features(text: str | None, good: bytes, bad: bytes) -> list[float]:
    parts = blocks((text or "").encode())
    g, b = compressor(good).compress, compressor(bad).compress
    sizes = np.array([(len(g(p)), len(b(p)), len(p)) for p in parts], float)
    each = (sizes[:, 1] - sizes[:, 0]) / np.maximum(sizes[:, 2], 32)
    cg, cb, n = sizes.sum(0)
    n = max(n, 32)
    x = [(cb - cg) / n, each.min(), each.max(), cg / n, cb / n, np.log(n)]
    return [*x, *(v * v for v in x), *(x[0] * v for v in x[1:])]


def _folds(sample: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Different texts for the dictionaries and for the calibration."""
    fold = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit("d")).cast("binary")) % 2
    return sample.where(fold == 0), sample.where(fold == 1)


class Model:
    def __init__(self, good: bytes, bad: bytes, fit: linear.Logistic | linear.Constant):
        self.good, self.bad, self.fit = good, bad, fit

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        if isinstance(self.fit, linear.Constant):
            return self.fit(np.empty((len(texts), 0)))
        return self.fit(np.array([features(t, self.good, self.bad) for t in texts]))


def fit(docs: DataFrame, labels: DataFrame, name: str = "quality", rows: int = ROWS, parts: int = PARTS) -> Model:
    spark = docs.sparkSession
    shares = {r[0]: r[1] for r in sampling.train_labels(labels, name).groupBy("label").count().collect()}
    if len(shares) < 2:
        return Model(b"", b"", linear.Constant(float(next(iter(shares))) if shares else 0.5))
    some = common.materialize(sampling.sample(docs, labels, name, {0: 2 * rows, 1: 2 * rows}), "quality-sample")
    first, second = _folds(some)
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    for r in first.orderBy("doc_id", "label").toLocalIterator():  # bounded rows of bounded texts
        texts[r["label"]].append(r["text"].encode())
    shared = spark.sparkContext.broadcast((dictionary(texts[1], parts), dictionary(texts[0], parts)))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            xs = [features(t, *shared.value) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(xs, pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    got = second.select("doc_id", "label", "text").mapInArrow(run, "doc_id bigint, label int, x array<double>").orderBy("doc_id", "label").collect()
    y = np.array([r["label"] for r in got], float)
    x = np.array([r["x"] for r in got]) if got else np.empty((0, 1))
    counts = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.array([shares[int(c)] / counts[int(c)] for c in y])
    return Model(*shared.value, linear.fit(x, y, weight * len(y) / max(weight.sum(), 1e-9)))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            s = shared.value(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    rows = common.only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(run, "doc_id bigint, score double")
    return rows.select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
