"""The pipeline against a brute-force version of each stage, and what it does with planted cases."""

import random

import corpus_pipeline
from tests.llm import test_decontamination, test_minhash, test_suffix_dedup
from tests.llm.test_packing import brute_bins, tokenizer
from voxelweave.llm import packing, toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_stages(spark, sf):
    """(stage name, expected rows as {doc_id: text}) of every filtering stage, each on the one before."""
    docs, labels, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    model = toxicity.fit(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [r for r, s in zip(rows, model([t for _, t in rows]), strict=True) if s < 0.5]
    yield "toxicity", dict(rows)
    kept = {d for d, _, _, k in test_minhash.brute(rows, 80) if k}
    rows = [r for r in rows if r[0] in kept]
    yield "near_duplicates", dict(rows)
    cut = {d: (n, k.decode(errors="ignore")) for d, n, _, _, k in test_suffix_dedup.brute(rows, 200)}
    rows = [(d, cut[d][1]) for d, _ in rows if cut[d][1] or not cut[d][0]]
    yield "suffix_dedup", dict(rows)
    bench = [(r.item_id, r.text) for r in items.collect()]
    out = {}
    for d, t in rows:
        n, hit, _ = test_decontamination.brute(t, bench)
        if len(hit) <= 0.5 * n:
            out[d] = (t, hit)
    yield "decontamination", out


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, ((name, stage), (brute_name, want)) in enumerate(zip(corpus_pipeline.STAGES, brute_stages(spark, SF), strict=False)):
        assert name == brute_name
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == COLUMNS
        got = {r.doc_id: r.text for r in docs.collect()}
        if name == "decontamination":
            assert got.keys() == want.keys()
            assert all(got[d] == t if not hit else len(got[d]) < len(t) for d, (t, hit) in want.items())
        else:
            assert got == want
    tok = tokenizer()
    lengths = [n for r in docs.collect() for _, n in packing.cut(len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1, 1024)]
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.length for r in out) == sorted(lengths)
    assert len({r.sequence_id for r in out}) == len(brute_bins(lengths, 1024))


def test_planted_cases(spark, tmp_path):
    rnd = random.Random(8)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    prose = lambda n: " ".join(rnd.choices(vocab, k=n))
    item, passage, base = prose(30), prose(70), prose(150)
    rows = {i: prose(80) for i in range(100)}
    rows |= {200 + i: f"{prose(40)} you stupid idiot, worthless trash {prose(10)}" for i in range(40)}
    rows |= {300: base, 301: base, 302: base.replace(base.split()[75], "changed", 1)}
    rows |= {400: f"{prose(60)} {item} {prose(60)}", 500: f"{prose(60)} {passage} {prose(60)}", 501: f"{prose(60)} {passage} {prose(60)}"}
    table = [(d, t, "en", "s", len(t)) for d, t in rows.items()]
    spark.createDataFrame(table, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, 1, int(200 <= d < 230)) for d in [*range(80), *range(200, 230)]], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    left = {r.doc_id: r.text for r in docs.collect()}
    assert left.keys() == {*range(100), 300, 400, 500, 501}
    assert all(left[d] == rows[d] for d in [*range(100), 300])
    assert item not in left[400] and len(left[400]) > 300
    assert passage[:200] not in left[500] and passage[:200] not in left[501] and len(left[500]) > 300


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, doc string, spans int"


def odd(spark, tmp_path, rows):
    """Tables with these documents, extra columns named as the operators name theirs, no label and no benchmark item."""
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return spark.createDataFrame([(d, t, None, "s", None if t is None else len(t), "x", k) for k, (d, t) in enumerate(rows)], SCHEMA)


def test_odd_rows_in_every_stage(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (None, "a text without an id"), (None, None), (3, "once"), (3, "once"), (3, "other text of that id"), (4, long), (5, "you stupid idiot, worthless scum and trash"), (6, "\n \t")]
    docs = odd(spark, tmp_path, rows)
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        kept[name] = sorted((r.spans for r in spark.read.parquet(f"{tmp_path}/{k}").collect()))
    assert kept["toxicity"] == [0, 1, 2, 3, 4, 5, 6, 7, 9]
    assert [k for k in kept["near_duplicates"] if k != 5] == [0, 1, 2, 3, 4, 6, 7, 8, 9]  # one of two rows of one id and text is kept or both are
    assert kept["suffix_dedup"] == kept["decontamination"] == list(range(10))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sum(r.piece == 0 for r in packed) == 10 and sum(r.length for r in packed if r.doc_id in (1, 2)) == 2
    assert len([r for r in packed if r.doc_id == 4]) > 50


def test_empty_tables_in_every_stage(spark, tmp_path):
    docs = odd(spark, tmp_path, [])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0
    docs.select(*COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
