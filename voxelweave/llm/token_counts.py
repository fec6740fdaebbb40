"""Token counts of whole texts, from counts of their pre-tokens.

The model's merges never cross certain places: no piece has a word mark after another character, and
none has a line break beside anything. A text, with its blanks as word marks and one more in front, is
cut there into pre-tokens; a pre-token's pieces do not depend on what stands beside it. Those of more than
``CUT`` characters are cut further, between neighbours that no piece of the vocabulary has side by side,
which is as exact (scripts without blanks come out as short pre-tokens).

One pass counts the pre-tokens of the corpus, and the pieces of each distinct one are counted once. A
second pass meets each document's own frequencies with those counts and sums up; ids are never kept. The
most frequent pre-tokens, at most ``HOT`` with keys of at most ``KEY_BYTES`` bytes, are broadcast, and a
document's sum over them is made where it lies. Its other pre-tokens meet their counts in a shuffled join; by
the choice of the first, none of those is in more than a small share of documents.

Defined results: null and empty text have no tokens; documents sharing an id, or with a null id, are
counted each on its own; an empty table gives no rows; other columns are ignored. Texts of any length
are counted whole; a task holds one text and its distinct pre-tokens. A pre-token that cannot be cut (a
long run of one letter) is encoded in one piece.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Characters of a pre-token from which on it is cut further, and bytes of a key that stands for itself.
CUT, KEY_BYTES = 48, 64
#: Pre-tokens whose counts are broadcast, at most; distinct ones that a task holds before it passes them on.
HOT, HELD = 1 << 20, 1 << 17
#: Characters of a text that are cut into pre-tokens at a time, about.
SLICE = 1 << 20
#: Steps of a doubling by which frequencies are compared.
STEPS = 16
_MARK = "▁"
_PRE = re.compile(f"{_MARK}*[^{_MARK}\n]+|{_MARK}+|\n")
_PLACE = re.compile(f"\n|(?<=[^{_MARK}\n]){_MARK}")


def model_path(model: str | None) -> str:
    import public_tokenizers

    return model or public_tokenizers.path(MODEL)


class Pieces:
    """Pre-tokens of texts, and the number of pieces of each."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pairs: set[str] = set()
        for i in range(self.model.vocab_size()):
            if self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i):
                continue
            piece = self.model.id_to_piece(i)
            if "\n" in piece or _MARK in piece.lstrip(_MARK):
                raise ValueError(f"{path}: piece {piece!r} crosses pre-tokens")
            self.pairs.update(map("".join, zip(piece, piece[1:], strict=False)))
        if self.model.normalize("a  b ") != f"{_MARK}a{_MARK}{_MARK}b{_MARK}":
            raise ValueError(f"{path}: texts are normalised before they are cut")
        self.guard = len(self.model.encode("\n"))

    def _cut(self, token: str) -> Iterator[str]:
        start = 0
        for i in range(1, len(token)):
            if token[i - 1 : i + 1] not in self.pairs:
                yield token[start:i]
                start = i
        yield token[start:]

    def frequencies(self, text: str | None) -> Counter[str]:
        """Distinct pre-tokens of a text with their numbers."""
        found: Counter[str] = Counter()
        if not text:
            return found
        marked, start = _MARK + text.replace(" ", _MARK), 0
        while start < len(marked):
            place = _PLACE.search(marked, start + SLICE)
            end = place.start() if place else len(marked)
            found.update(_PRE.findall(marked, start, end))
            start = end
        for token in [t for t in found if len(t) > CUT]:
            n = found.pop(token)
            for part, k in Counter(self._cut(token)).items():
                found[part] += n * k
        return found

    def counts(self, tokens: list[str]) -> list[int]:
        """Pieces of each; a line break before it keeps the model's own word mark away."""
        return [len(ids) - self.guard for ids in self.model.encode(["\n" + t for t in tokens], num_threads=1)]


@functools.lru_cache(2)
def pieces(path: str) -> Pieces:
    """One for all tasks of a worker."""
    return Pieces(path)


def key(token: str) -> str:
    """The pre-token, or for a longer one its SHA-256 behind a mark that makes it longer than any that stands for itself."""
    raw = token.encode()
    return token if len(raw) <= KEY_BYTES else "#" + hashlib.sha256(raw).hexdigest()


def _corpus(texts: DataFrame, path: str) -> DataFrame:
    """(token, n): pre-tokens with the number of documents that have them."""

    def run(batches: Iterator[pa.RecordBatch]):
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["token", "n"])

        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(pieces(path).frequencies(text.as_py()).keys())
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        yield out()

    return texts.select("text").mapInArrow(run, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def vocabulary(texts: DataFrame, path: str) -> DataFrame:
    """(key, n, pieces) of every distinct pre-token."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            cols = [pa.array([key(t) for t in tokens], pa.string()), batch.column(1), pa.array(pieces(path).counts(tokens), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["key", "n", "pieces"])

    return _corpus(texts, path).mapInArrow(run, "key string, n bigint, pieces bigint")


def _documents(texts: DataFrame, path: str, hot: dict[str, int]) -> DataFrame:
    """(row, doc_id, n_bytes, n_tokens, rest) of each document: the pieces of its hot pre-tokens, and its others with their numbers."""
    shared = texts.sparkSession.sparkContext.broadcast(hot)  # at most HOT short keys
    rest_type = pa.list_(pa.struct([("key", pa.string()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]):
        known = shared.value
        for batch in batches:
            totals, rests = [], []
            for text in batch.column(3):
                total, rest = 0, []
                for token, n in pieces(path).frequencies(text.as_py()).items():
                    c = known.get(token)
                    if c is None:
                        k = key(token)
                        c = known.get(k) if k is not token else None
                        if c is None:
                            rest.append({"key": k, "n": n})
                            continue
                    total += n * c
                totals.append(total)
                rests.append(rest)
            cols = [*(batch.column(i) for i in range(3)), pa.array(totals, pa.int64()), pa.array(rests, rest_type)]
            yield pa.RecordBatch.from_arrays(cols, ["row", "doc_id", "n_bytes", "n_tokens", "rest"])

    return texts.mapInArrow(run, "row bigint, doc_id bigint, n_bytes bigint, n_tokens bigint, rest array<struct<key:string,n:bigint>>")


def _hot(known: DataFrame, most: int) -> int:
    """The least level from which on there are at most so many pre-tokens."""
    sizes = known.groupBy("level").count().orderBy(F.desc("level")).collect()  # a row for each level: below 64 * STEPS
    total, least = 0, 1 << 30
    for r in sizes:
        total += r["count"]
        if total > most:
            break
        least = r["level"]
    return least


def count(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    path = model_path(model)
    texts = common.only(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), "text")
    level = F.floor(F.log2("n") * STEPS).cast("int").alias("level")
    known = common.materialize(vocabulary(texts, path).select("key", "pieces", level), "pre-tokens")
    least = _hot(known, HOT)
    hot = known.where(F.col("level") >= least).select("key", "pieces").toArrow()  # at most HOT short keys and numbers
    hot = dict(zip(hot.column(0).to_pylist(), hot.column(1).to_pylist(), strict=True))
    sums = common.materialize(_documents(texts, path, hot), "token-sums")
    rest = sums.select("row", F.explode("rest").alias("r")).select("row", "r.key", "r.n")
    rest = rest.join(known.where(F.col("level") < least).select("key", "pieces"), "key")
    rest = rest.groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    n_tokens = (F.col("n_tokens") + F.coalesce("more", F.lit(0))).alias("n_tokens")
    total = sums.join(rest, "row", "left").select("doc_id", "n_bytes", n_tokens)
    return total.withColumn("over_limit", F.col("n_tokens") > limit)
