import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelweave.llm import common
from voxelweave.llm import suffix_dedup as S
from voxelweave.llm.suffix_sort import repeated_starts, suffix_ranks

SCHEMA = "doc_id bigint, text string, n_chars bigint, DOC string"


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc, _), d in zip(rows, data, strict=True):
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((doc, len(d), sum(gone), sum(g and not p for g, p in zip(gone, b"\0" + gone, strict=False)), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(40))
def test_repeated_starts(seed):
    r = random.Random(seed)
    d = bytes(r.choices(range(97, 97 + r.choice([1, 2, 3, 26])), k=r.randint(60, 300)))
    for _ in range(3):
        a = r.randrange(len(d))
        d += d[a : a + r.randint(1, 120)]
    length = r.choice([1, 3, 7, 8, 9, 16, 20, 30, 50])
    valid = np.array(sorted(r.sample(range(len(d) - length + 1), r.randint(1, len(d) - length + 1))))
    c = Counter(d[i : i + length] for i in valid)
    assert repeated_starts(d, valid, length).tolist() == [i for i in valid if c[d[i : i + length]] > 1]


@pytest.mark.parametrize("seed", range(10))
def test_ranks_order_whole_suffixes(seed):
    r = random.Random(seed)
    s = [r.randint(1, r.choice([2, 5, 50])) for _ in range(r.randint(1, 200))]
    ranks = suffix_ranks(np.array(s, np.uint64), len(s) + 3)
    assert [int(i) for i in np.argsort(ranks)] == sorted(range(len(s)), key=lambda i: s[i:])


def same_checksum(rnd, repeated):
    """Another text of the same crc32 as repeated + some letters; both are tried until two meet."""
    other, seen = "".join(rnd.choices("abcdefgh ", k=500)), {}
    base = [zlib.crc32(t.encode()) for t in (other, repeated)]
    tail = lambda: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=12))
    for t in (tail() for _ in range(250_000)):
        seen[zlib.crc32(t.encode(), base[0])] = t
    for t in (tail() for _ in range(250_000)):
        if hit := seen.get(zlib.crc32(t.encode(), base[1])):
            return other + hit, repeated + t
    raise AssertionError("no texts of one checksum were found")


def texts(rnd):
    word = lambda: "".join(rnd.choices("abcdefghé", k=rnd.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(60), prose(200), "ab" * 400, "ü" * 500, " " * 700]
    out = [prose(rnd.randint(0, 150)) for _ in range(20)]
    for _ in range(40):
        out.append(prose(rnd.randint(0, 60)) + rnd.choice(shared) + prose(rnd.randint(0, 60)) + rnd.choice(shared)[: rnd.randint(0, 300)])
    whole = prose(300)
    return [*out, whole, whole, whole[5:], "x" + whole[:-7], prose(30_000), None, "", None, "a" * 199, "a" * 200]


@pytest.mark.parametrize("limits", [{}, {"file_chunks": 3, "block_bytes": 5000}, {"file_chunks": 1}, {"file_chunks": 1, "widths": (60, 1)}])
def test_spans_equal_brute_force(spark, limits):
    rnd = random.Random(str(limits))
    rows = list(enumerate(texts(rnd)))
    rows += [(None, rows[25][1]), (None, None), (7, rows[30][1]), (7, rows[7][1]), (7, "other text")]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)
    out = S.repeats(df, **limits).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out), key=str)
    assert got == brute(rows, 200)


@pytest.mark.parametrize("half", ["content", "content2"])
def test_chunks_with_equal_64_bits_are_told_apart(spark, monkeypatch, half):
    every = S._all_chunks
    monkeypatch.setattr(S, "_all_chunks", lambda *a: every(*a).withColumn(half, F.lit(0).cast("bigint")))
    rows = list(enumerate(texts(random.Random(6))))
    out = S.repeats(spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out), key=str) == brute(rows, 200)


def test_texts_of_one_checksum_and_id_are_told_apart(spark):
    rnd = random.Random(9)
    passage = "".join(rnd.choices("abcdefgh ", k=300))
    found, wanted = same_checksum(rnd, passage * 2)
    assert found != wanted and zlib.crc32(found.encode()) == zlib.crc32(wanted.encode())
    out = S.repeats(spark.createDataFrame([(None, wanted, 0, ""), (None, found, 0, "")], SCHEMA)).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in out) == [(len(found), 0), (len(wanted), 600)]


def test_hot_keys_are_spread(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 3)
    monkeypatch.setattr(common, "HOT_SHARE", 10**6)
    rows = list(enumerate(texts(random.Random(12))))
    out = S.repeats(spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA), file_chunks=4).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out), key=str) == brute(rows, 200)


def test_pieces_of_a_chunk_hold_its_windows():
    rnd = random.Random(2)
    data = bytes(rnd.choices(b"abc", k=3000))
    for _, start, size in zip(*S.chunks(data), strict=True):
        chunk = data[start : start + size]
        for width in S.WIDTHS:
            at = 0
            for _, a, n in S.parted(chunk, width):
                assert a == at and n >= 200
                at = a + n - 199
            assert at == len(chunk) - 199


def test_remove_keeps_clean_documents(spark):
    passage = "".join(random.Random(3).choices("abcdefgh ", k=400))
    rows = [(1, "clean é text", 12, "k"), (2, "start " + passage + "é end", 9, None), (3, passage, 400, ""), (4, None, None, "z"), (5, "", 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.doc_id: r for r in S.remove(df).collect()}
    assert set(out) == {1, 2, 4, 5} and tuple(out[1]) == rows[0] and tuple(out[4]) == rows[3]
    assert out[2].text == "start é end" and out[2].n_chars == len("start é end")
    assert S.remove(df).columns == df.columns


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert S.repeats(empty).count() == 0 and S.remove(empty).count() == 0


def test_chunks_cover_all_windows():
    data = "".join(random.Random(5).choices("ab", k=150_000)).encode()
    file, start, size = S.chunks(data)
    assert start[0] == 0 and (start[1:] == start[:-1] + size[:-1] - 199).all() and start[-1] + size[-1] == len(data)
    assert len(file) == len(start)
