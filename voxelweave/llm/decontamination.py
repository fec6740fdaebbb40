"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

Automata are built from the benchmark's items, each over at most ``MAX_ITEM_WORDS`` words of them (one
for a usual benchmark), and broadcast; documents stream through where they lie, without a shuffle.
Several automata take a pass each, one after the other; spans and items are merged, as with one. A document's words become small ids; only runs of
words whose neighbouring pairs all occur in the benchmark are walked, tracking the longest matching
length at each word. Everything else cannot hold a window.

Words: A-Z lower-cased, then maximal runs of bytes that are digits, a-z or above 0x7F. A window is
``window`` consecutive words of an item, or the whole item if it has fewer.

Defined results: null or empty text has no words; items without words, text or id match nothing;
items that share an id count once. An item longer than a whole automaton is cut into pieces that
overlap by a window less one word, so no window is lost. Every input row gives a result of its own, repeated
rows and rows without an id too; texts of any length are walked whole (a task holds one text and its words); an
empty table of documents gives no rows, an empty benchmark no hits; other columns, whatever their names, are
ignored by ``find`` and kept by ``remove``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from . import common

WINDOW = 10
#: Words of the items of one automaton; about 0.5 KB of automaton each.
MAX_ITEM_WORDS = 2_000_000
#: Limits of the removing stage: a document keeps at most this share of hit words, else it goes.
MAX_COVERAGE = 0.5
#: Spans of fewer words than this stay.
MIN_SPAN = 1
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_PAIRS = 1 << 22
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


class ItemAutomaton:
    """Generalised suffix automaton of several word sequences."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for name, words in items if words]
        for _, ids in numbered:
            state = 0
            for c in ids:
                state = self._extend(state, c)
        self.names: list[str] = sorted({name for name, _ in numbered})
        number = {name: i for i, name in enumerate(self.names)}
        self.windows: dict[int, set[int]] = {}  # state of a window: its items
        self.short: dict[int, list[tuple[int, int]]] = {}  # state: (words, item) of items that end there whole
        self.pairs = np.zeros(_PAIRS, bool)
        for name, ids in numbered:
            state = 0
            for k, c in enumerate(ids):
                state = self.next[state][c]
                if k + 1 >= window:
                    self.windows.setdefault(self._locus(state), set()).add(number[name])
            if len(ids) < window:
                self.short.setdefault(state, []).append((len(ids), number[name]))
            a = np.array(ids, np.int64)
            self.pairs[self._pair(a[:-1], a[1:])] = True
        self.least = min((min(len(ids), window) for _, ids in numbered), default=0)
        # the nearest state up the suffix links, itself included, where a short item ends
        self.near = [-1] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.near[s] = s if s in self.short else self.near[self.link[s]] if self.link[s] >= 0 else -1

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 0x9E3779B1 + b * 0x85EBCA77) % _PAIRS

    def _clone(self, p: int, q: int, c: int) -> int:
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        new = len(self.next) - 1
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:  # another item has this prefix
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        new, p = len(self.next) - 1, last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
        return new

    def _locus(self, state: int) -> int:
        """The state of the last ``window`` words of a match that ends in state."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        if self.least < 2:
            ok, extra = ids >= 0, 0
        else:
            a, b = ids[:-1], ids[1:]
            ok, extra = (a >= 0) & (b >= 0), 1
            ok[ok] = self.pairs[self._pair(a[ok], b[ok])]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], ok.view(np.int8), [0]))))
        starts, ends = edges[::2], edges[1::2] + extra
        keep = ends - starts >= self.least
        return zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Merged [start, end) word spans under occurring windows, and the numbers of their items."""
        if not self.least or len(words) < self.least:
            return [], set()
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        spans: list[list[int]] = []
        items: set[int] = set()
        w, nxt, link, length = self.window, self.next, self.link, self.length

        def hit(start: int, end: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append([start, end])

        for start, end in self._runs(ids):
            state = n = 0
            for k, c in enumerate(ids[start:end].tolist(), start):
                while state and c not in nxt[state]:
                    state = link[state]
                    n = length[state]
                if c in nxt[state]:
                    state, n = nxt[state][c], n + 1
                else:
                    n = 0
                    continue
                if n >= w:
                    at = self._locus(state)
                    items |= self.windows.get(at, ())
                    hit(k + 1 - w, k + 1)
                at = self.near[state]
                while at > 0:
                    for m, item in self.short[at]:
                        if m <= n:
                            items.add(item)
                            hit(k + 1 - m, k + 1)
                    at = self.near[link[at]] if link[at] >= 0 else -1
        return [(a, b) for a, b in spans], items


def _dealt(items: Iterable[tuple[str, list[bytes]]], window: int, most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in groups of at most so many words; a longer item in pieces that share window - 1 words."""
    most, group, size = max(most, 2 * window), [], 0
    for name, words in items:
        for at in range(0, max(1, len(words) - window + 1), most - window + 1):
            piece = words[at : at + most]
            if size and size + len(piece) > most:
                yield group
                group, size = [], 0
            group.append((name, piece))
            size += len(piece)
    yield group


def _hits(auto: ItemAutomaton, words: list[bytes], spans: list[dict] | None, items: list[str] | None) -> tuple[list[tuple[int, int]], list[str]]:
    """Merged spans and sorted items of an automaton and of the passes before it."""
    found, numbers = auto.find(words)
    out: list[tuple[int, int]] = []
    for start, end in sorted([*found, *((s["start"], s["end"]) for s in spans or ())]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out, sorted({auto.names[i] for i in numbers} | set(items or ()))


def _before(batch: pa.RecordBatch, width: int) -> tuple[list, list]:
    """Spans and items that passes before have put after the first width columns."""
    if batch.num_columns == width:
        return [None] * batch.num_rows, [None] * batch.num_rows
    return batch.column(width).to_pylist(), batch.column(width + 1).to_pylist()


def _passes(docs: DataFrame, at: int, benchmark: DataFrame, window: int) -> tuple[DataFrame, ItemAutomaton]:
    """The last automaton, and the documents with what all before it find in the text in column at (as they are if it is the only one)."""
    rows = common.only(benchmark, "item_id", "text").where("item_id is not null and text is not null")
    groups = _dealt(((str(r[0]), words_of(r[1])) for r in rows.toLocalIterator()), window, MAX_ITEM_WORDS)
    group, width, out = next(groups), len(docs.columns), docs
    for following in groups:
        before = out
        if before is docs:
            out = docs.toDF(*(f"_c{i}" for i in range(width)))
        shared = docs.sparkSession.sparkContext.broadcast(ItemAutomaton(group, window))

        def run(batches, shared=shared):
            for batch in batches:
                hits = [_hits(shared.value, words_of(t), *b) for t, *b in zip(batch.column(at).to_pylist(), *_before(batch, width), strict=True)]
                spans = pa.array([[{"start": a, "end": b} for a, b in s] for s, _ in hits], _SPANS)
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], spans, pa.array([i for _, i in hits], pa.list_(pa.string()))], [*(f"_c{i}" for i in range(width)), "_spans", "_items"])

        schema = StructType(out.schema.fields[:width]).add("_spans", ArrayType(StructType().add("start", "long").add("end", "long"))).add("_items", ArrayType(StringType()))
        out = common.materialize(out.mapInArrow(run, schema), "hits")
        if before is not docs:
            common.release(before)
        shared.unpersist()
        group = following
    return out, ItemAutomaton(group, window)


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, spans (word positions [start, end) under windows), items (ids, sorted)."""
    rows = common.only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows, auto = _passes(rows, 1, benchmark, window)
    shared = docs.sparkSession.sparkContext.broadcast(auto)

    def run(batches):
        auto = shared.value
        for batch in batches:
            out = []
            for d, text, *before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *_before(batch, 2), strict=True):
                words = words_of(text)
                spans, items = _hits(auto, words, *before)
                out.append({"doc_id": d, "n_words": len(words), "spans": [{"start": a, "end": b} for a, b in spans], "items": items})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string()))]))

    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>")


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    data = text.encode()
    at = [m.span() for m in _WORD.finditer(data)]
    keep, last = [], 0
    for a, b in spans:
        keep.append(data[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*keep, data[last:]]).decode()


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_span: int = MIN_SPAN, max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """Documents without the spans of min_span words or more that lie under windows.

    A document of which more than max_coverage of the words are hit goes altogether. n_chars, if
    there, is counted anew for documents that were cut. Columns and other rows stay as they are.
    """
    names = docs.columns
    rows, auto = _passes(docs, names.index("text"), benchmark, window)
    shared = docs.sparkSession.sparkContext.broadcast(auto)

    def run(batches):
        auto = shared.value
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist()
            chars = batch.column(names.index("n_chars")).to_pylist() if "n_chars" in names else None
            keep = []
            for i, (text, *before) in enumerate(zip(texts.copy(), *_before(batch, len(names)), strict=True)):
                words = words_of(text)
                spans, _ = _hits(auto, words, *before)
                if sum(b - a for a, b in spans) > max_coverage * len(words):
                    continue
                keep.append(i)
                if spans := [(a, b) for a, b in spans if b - a >= min_span]:
                    texts[i] = _cut(text, spans)
                    if chars:
                        chars[i] = len(texts[i])
            cols = list(batch.columns)[: len(names)]
            cols[names.index("text")] = pa.array(texts, batch.schema.field(names.index("text")).type)
            if chars:
                cols[names.index("n_chars")] = pa.array(chars, batch.schema.field(names.index("n_chars")).type)
            yield pa.RecordBatch.from_arrays(cols, names).take(pa.array(keep, pa.int64()))

    return rows.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The counts of ``find`` as plain columns."""
    hits = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))


