"""Token counts against encoding every text whole."""

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from voxelweave.llm import token_counts
from voxelweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def check(rows, got, model, limit=4096):
    want = sorted(((d, len((t or "").encode()), n := len(model.encode(t or "")), n > limit) for d, t in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_query_equals_whole_texts(spark, model):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, QUERIES["op11_token_counts"](spark, SF).collect(), model)


ODD = ["", None, " ", "   ", "\n", " \n ", "a\n\nb", "a \n b", "</s>[INST] <s>", "▁x ▁", "\r\n\r\r", "\x00a", "日本語のテキスト" * 40, "a" * 5000, "ab" * 900, " " * 3000, "\n" * 300,
       "word " * 20000, "x　y\xa0z", "😀👩‍👩‍👧", "é ﬁ ½", "https://example.org/" + "a1b2c3/" * 300, "<0x0A><unk>", "\t\tif (x) {\r\n}"]


def test_odd_texts(spark, model, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "no id"), (None, None)]
    data = spark.createDataFrame(rows, SCHEMA)
    check(rows, token_counts.count(data).collect(), model)
    # few broadcast, few held, short slices: the rest meets in the shuffled join
    monkeypatch.setattr(token_counts, "HOT", 3)
    monkeypatch.setattr(token_counts, "HELD", 4)
    monkeypatch.setattr(token_counts, "SLICE", 7)
    check(rows, token_counts.count(data, limit=5).collect(), model, 5)


def test_whole_table_with_few_broadcast(spark, model, monkeypatch):
    monkeypatch.setattr(token_counts, "HOT", 200)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, token_counts.count(spark.createDataFrame(rows, SCHEMA)).collect(), model)


def test_empty_table_and_clashing_columns(spark, model):
    assert token_counts.count(spark.createDataFrame([], SCHEMA)).count() == 0
    data = spark.createDataFrame([(1, "one two", "x", 9, "k")], "doc_id bigint, text string, TEXT string, n bigint, key string")
    check([(1, "one two")], token_counts.count(data).collect(), model)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\r\tabcde.,(){};\"'▁éß日本1230<>/\x00́"), max_size=120))
def test_pieces_of_pre_tokens(text):
    p = token_counts.pieces(MODEL)
    found = p.frequencies(text)
    assert sum(n * c for n, c in zip(found.values(), p.counts(list(found)), strict=True)) == len(p.model.encode(text))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    p = token_counts.pieces(MODEL)
    found = p.frequencies(text * 3)
    assert sum(n * c for n, c in zip(found.values(), p.counts(list(found)), strict=True)) == len(p.model.encode(text * 3))


@pytest.mark.parametrize("size", [1, 2, 5, 50])
def test_slices_cut_no_pre_token(size, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE", size)
    p = token_counts.pieces(MODEL)
    for text in ODD:
        found = p.frequencies(text)
        assert sum(n * c for n, c in zip(found.values(), p.counts(list(found)), strict=True)) == len(p.model.encode(text or ""))


def test_texts_are_not_normalised(model):
    for start in range(0, 0x11000, 64):
        text = "".join(chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert model.normalize(text) == ("▁" + text.replace(" ", "▁") if text else "")
