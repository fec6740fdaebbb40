import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from voxelweave.llm import packing as P

SCHEMA = "doc_id bigint, text string, Doc_ID string"


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.files(None)[0])


def brute_bins(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in bins if r >= n]
        if fit:
            bins.remove(min(fit))
            bins.append(min(fit) - n)
        else:
            bins.append(capacity - n)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_piecewise_best_fit(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 16, 100, 1024])
    lengths = [rnd.randint(1, capacity) if seed % 3 else min(capacity, 1 + int(rnd.expovariate(8 / capacity))) for _ in range(rnd.randint(0, 400))]
    hist = defaultdict(int)
    for n in lengths:
        hist[n] += 1
    plan, bins = P.plan_best_fit(hist, capacity)
    fill = defaultdict(list)
    for length, _, take, first, each, offset in plan.tolist():
        for k in range(take):
            fill[first + k // each].append((offset + k % each * length, length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(fill) == bins
    assert sorted(capacity - sum(n for _, n in p) for p in fill.values()) == brute_bins(lengths, capacity)


def test_ids_are_those_of_the_tokenizer():
    tok, enc, slow = tokenizer(), P.Encoder(*P.files(None)), P.Encoder(P.files(None)[0], None)
    rnd = random.Random(1)
    alphabet = ["a", "the", " ", "  ", "\n", "\t", "!!", "é", "ß9", "12", "'s", "\xa0", " I'll", "\x85", "日本", "😀", "<|endoftext|>", "\r\n", "\x1c", "\u2003", "²", "ª", "x" * 700, "\x00", "\xad"]
    one = [chr(c) + x + chr(c) for c in range(256) for x in ("a", " ", "1", "")]
    texts = ["", " ", "  ", "\n ", " \n", *one, *("".join(rnd.choices(alphabet, k=rnd.randint(0, 30))) for _ in range(3000))]
    texts += ["".join(rnd.choices(alphabet[:11], k=12)) for _ in range(3000)]
    for text in texts:
        want = tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc(text), "<u4").tolist() == want == np.frombuffer(slow(text), "<u4").tolist(), repr(text)


def test_layout(spark):
    long = " ".join(f"word{i}" for i in range(3000))
    rows = [(1, "hello world", "x"), (2, None, "x"), (3, "", None), (4, long, "y"), (4, long, "y"), (None, "no id", "z"), *((i, "same text here", "c") for i in range(10, 60))]
    df = spark.createDataFrame(rows, SCHEMA)
    out = P.pack(df).collect()
    tok = tokenizer()
    want = defaultdict(list)
    for doc, text, _ in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for k, (s, n) in enumerate(P.cut(len(ids), 1024)):
            want[doc].append((k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
    got = defaultdict(list)
    places = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for parts in places.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(places) == len(brute_bins([r.length for r in out], 1024))


def test_sequences_hold_the_ids(spark):
    df = spark.createDataFrame([(1, "a b c d e f g", ""), (2, "hello", ""), (3, None, "")], SCHEMA)
    tok = tokenizer()
    out = P.sequences(df, P.pack(df)).collect()
    ids = sorted(x for t in ("a b c d e f g", "hello", "") for x in [*tok.encode(t, add_special_tokens=False).ids, 2])
    assert sorted(x for r in out for x in r.ids) == ids


def test_empty_table(spark):
    out = P.pack(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() == 0
