import hashlib
import random
import re

import pytest

from voxelweave.llm import decontamination as D

DOCS = "doc_id bigint, text string, n_chars bigint, ITEM_ID string"
ITEMS = "item_id bigint, text string, doc_id string"


def brute(text, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words = split(text)
    hit, names = set(), set()
    for name, item in items:
        if name is None:
            continue
        w = split(item)
        for k in range(max(1, len(w) - window + 1)):
            if part := w[k : k + window]:
                for i in range(len(words) - len(part) + 1):
                    if words[i : i + len(part)] == part:
                        hit.update(range(i, i + len(part)))
                        names.add(str(name))
    return len(words), hit, sorted(names)


@pytest.mark.parametrize("seed", range(6))
def test_find_equals_brute_force(seed):
    rnd = random.Random(seed)
    vocab = ["a", "b", "c", "É", "éa", "x1", "Zz"][: rnd.randint(2, 7)]
    text = lambda n: "".join(rnd.choice(vocab) + rnd.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rnd.randint(0 if seed % 2 else 8, 20))) for i in range(6)]
    docs = [text(rnd.randint(0, 60)) for _ in range(40)] + [text(5) + items[1][1] + text(5), items[2][1] * 2, ""]
    auto = D.ItemAutomaton([(str(i), D.words_of(t)) for i, t in items])
    for t in docs:
        n, hit, names = brute(t, items)
        spans, found = auto.find(D.words_of(t))
        assert len(D.words_of(t)) == n
        assert {i for a, b in spans for i in range(a, b)} == hit
        assert sorted(auto.names[i] for i in found) == names
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


@pytest.mark.parametrize("most", [600, 1500])
def test_benchmarks_beyond_one_automaton(spark, monkeypatch, most):
    monkeypatch.setattr(D, "MAX_ITEM_WORDS", most)
    rnd = random.Random(most)
    text = lambda n: " ".join(rnd.choices(["a", "b", "c", "É", "x1"], k=n))
    items = [(i, text(rnd.choice([0, 3, 8, 25, 200]))) for i in range(30)] + [(4, text(30)), (90, text(2000))]
    rows = [(k, f"{text(15)} {t[: rnd.randint(0, 400)]} {text(9)} {t[-30:]}", 0, "") for k, (_, t) in enumerate(items)]
    rows += [(k, text(40), 0, "") for k in range(100, 130)]
    found = D.find(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(*i, "") for i in items], ITEMS)).collect()
    got = {r.doc_id: (r.n_words, {i for s in r.spans for i in range(s.start, s.end)}, r.items) for r in found}
    assert got == {d: brute(t, items) for d, t, *_ in rows}
    bench, df = spark.createDataFrame([(*i, "") for i in items], ITEMS), spark.createDataFrame(rows, DOCS)
    some = sorted(map(tuple, D.remove(df, bench).collect()))
    monkeypatch.setattr(D, "MAX_ITEM_WORDS", 10**6)
    assert some and some == sorted(map(tuple, D.remove(df, bench).collect()))


def test_query_columns_and_odd_rows(spark):
    item = "One two three, four five six seven eight nine ten eleven"
    rows = [(1, "x " + item.upper() + " y", 9, "k"), (2, None, None, None), (3, "", 0, ""), (None, item, 1, ""), (1, "nothing", 7, "")]
    items = spark.createDataFrame([(7, item, "d"), (8, None, None), (9, "  ", ""), (None, "nothing", ""), (10, item, "d")], ITEMS)
    out = D.digest(D.find(spark.createDataFrame(rows, DOCS), items)).collect()
    by = {(r.doc_id, r.n_words): r for r in out}
    both = hashlib.sha256(b"10,7").hexdigest()
    assert (by[1, 13].n_hit, by[1, 13].n_items, by[1, 13].items_sha256, by[1, 13].contaminated) == (11, 2, both, True)
    assert by[2, 0].items_sha256 == hashlib.sha256(b"").hexdigest() and not by[2, 0].contaminated
    assert by[None, 11].n_hit == 11 and by[1, 1].n_hit == 0 and by[3, 0].n_words == 0
    empty = spark.createDataFrame([], ITEMS)
    assert D.digest(D.find(spark.createDataFrame(rows, DOCS), empty)).where("contaminated").count() == 0
    assert D.find(spark.createDataFrame([], DOCS), items).count() == 0


def test_repeated_rows_and_very_long_texts(spark):
    rnd = random.Random(12)
    item = " ".join(f"i{k}" for k in range(25))
    long = " ".join(f"w{rnd.randint(0, 99)}" for _ in range(150_000)) + " " + item
    rows = [(1, item, 0, ""), (1, item, 0, ""), (None, item, 0, ""), (None, None, None, None), (2, long, len(long), "")]
    df, items = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(7, item, ""), (7, item, ""), (None, item, "")], ITEMS)
    out = D.digest(D.find(df, items)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items) for r in out) == [("1", 25, 25, 1)] * 2 + [("2", 150_025, 25, 1), ("None", 0, 0, 0), ("None", 25, 25, 1)]
    kept = D.remove(df, items).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["2", "None"]
    assert next(r for r in kept if r.doc_id == 2).text.split() == long.split()[:150_000]
    assert D.remove(df.limit(0), items).count() == 0 and D.remove(df, items.limit(0)).count() == len(rows)


def test_remove_cuts_spans_and_keeps_the_rest(spark):
    item = "One two three, four five six seven eight nine ten eleven"
    clean = " ".join(f"w{i}" for i in range(30))
    rows = [(1, f"{clean} é {item}! {clean}", 5, None), (2, item, 5, "x"), (3, None, None, None), (4, clean, 3, "x"), (5, "", 0, "x")]
    df = spark.createDataFrame(rows, DOCS)
    out = {r.doc_id: r for r in D.remove(df, spark.createDataFrame([(7, item, "")], ITEMS)).collect()}
    assert set(out) == {1, 3, 4, 5}
    assert out[1].text == f"{clean} é ! {clean}" and out[1].n_chars == len(out[1].text)
    assert tuple(out[4]) == rows[3] and tuple(out[3]) == rows[2]
