import random
import re

import pytest

from voxelweave.llm import graph
from voxelweave.llm import minhash as M

SCHEMA = "doc_id bigint, text string, lang string, KEY string"


def brute(rows, percent=85):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None and 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        comp = None if d is None else min(ids)
        out.append((d, len(sets[i]), comp, d == comp))
    return sorted(out, key=str)


def edited(rnd, words, n):
    w = list(words)
    for _ in range(n):
        w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("percent", (85, 80))
def test_groups_equal_brute_force(spark, percent):
    rnd = random.Random(percent)
    vocab = [f"w{i}" for i in range(500)]
    texts = []
    for n in (3, 30, 60, 120, 400):
        base = rnd.choices(vocab, k=n)
        texts += [" ".join(base)] * 3 + [edited(rnd, base, rnd.randint(1, max(1, n // 25))) for _ in range(25)]
    chain = rnd.choices(vocab, k=200)
    for _ in range(12):  # neighbours are alike, ends are not
        texts.append(" ".join(chain))
        chain = edited(rnd, chain, 2).split()
    passage = " ".join(rnd.choices(vocab, k=80))
    texts += [passage + " " + " ".join(rnd.choices(vocab, k=60)) for _ in range(30)]
    texts += [None, "", "  \t\n ", "One", "one", "A b\x0bc", "a B C", " ".join(rnd.choices(vocab, k=30_000))]
    rnd.shuffle(texts)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None)]
    rows += [(rows[0][0], "an id of two texts " * 9), (rows[1][0], rows[2][1]), rows[3], rows[3]]
    df = spark.createDataFrame([(*r, "en", None) for r in rows], SCHEMA)
    out = M.near_duplicates(df, percent).collect()
    assert sorted(map(tuple, out), key=str) == [(a, b, c, True if a is None else d) for a, b, c, d in brute(rows, percent)]


def test_keep_one_keeps_columns_and_the_smallest(spark):
    rows = [(5, "a b c d e f", "en", "k"), (3, "A b c d e f", None, None), (9, None, "x", "y"), (None, "a b c d e f", "z", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = M.keep_one(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {3, 9, None}


def test_words_of_a_structured_family_are_told_apart():
    thue = "a"
    for _ in range(11):
        thue += thue.translate(str.maketrans("ab", "ba"))
    other = thue.translate(str.maketrans("ab", "ba"))
    assert M.shingles(thue)[0] != M.shingles(other)[0]
    names = {M.shingles(w)[0] for w in ("a", "a\0", "\0a", "ab", "a" * 8, "a" * 9, "a" * 16, "a" * 17, "a" * 16 + "\0", "a b", "b a", "a a", "a a a")}
    assert len(names) == 13
    assert M.shingles("x " + thue + " y")[0] != M.shingles("x " + other + " y")[0]


def test_keep_one_of_ids_with_several_texts(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(3, a, "en", "k"), (5, a, "en", "copy"), (5, b, "en", "own"), (7, b, "en", None), (8, "alone here", "en", "1"), (8, "alone here", "en", "1"), (9, None, "", "1"), (9, "", "", "1")]
    out = M.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.text or "") for r in out) == [(3, a), (5, b), (8, "alone here"), (9, "")]


def test_links_between_80_and_85_percent(spark):
    words = [f"w{i}" for i in range(150)]
    edit = words.copy()
    for k in (20, 70, 120):
        edit[k] = "changed"  # 131 of 161 shingles
    df = spark.createDataFrame([(1, " ".join(words), "", ""), (2, " ".join(edit), "", "")], SCHEMA)
    assert [r.doc_id for r in M.keep_one(df).collect()] == [1]
    assert M.near_duplicates(df, 85).where("kept").count() == 2


def test_empty_table(spark):
    assert M.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (8, 7), (20, 7), (30, 31), (31, 30), (40, 40)]
    out = {r.id: r.root for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert out == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 7, 8: 7, 9: 7, 20: 7, 30: 30, 31: 30}
