"""op11: the agenda encoder against the sentencepiece library, on given documents and edge cases."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tipoff.llm import subwords
from tipoff.llm.queries import QUERIES, table

PATH = public_tokenizers.path(subwords.VOCABULARY)
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGES = ["", " ", "   ", "  a", "a  ", "\tfoo", "x▁ y", "中 文", "\x00a", "a　b", "😀x😀", "é" * 3000, "ab" * 20_000, "2024-05-11 x@y.com"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(library, text):
    ids = library.encode(text or "") + [library.eos_id()]
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


@given(st.text(alphabet=st.sampled_from(list("aeiou tnrsAB.,'\n\t▁é中😀0123")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_agenda_equals_library(text):
    model = subwords.load(PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = model.encode(text)
    assert ids == library.encode(text)
    assert model.decode(ids + [2]) == library.decode(ids + [2])


def test_units_and_cuts_are_exact(library):
    model = subwords.load(PATH)
    assert model.units
    for text in EDGES:
        assert model.merge(subwords.SPACE + text.replace(" ", subwords.SPACE)) == library.encode(text) if text else True
        assert model.encode(text) == library.encode(text)


def test_distinct_units_of_a_batch_are_merged_once_and_in_step(library, monkeypatch):
    model, merged = subwords.PieceModel(PATH), []
    in_step = model.merge_short
    monkeypatch.setattr(model, "merge_short", lambda characters: merged.append(len(characters)) or in_step(characters))
    texts = ["the words come again. " * 50 + f"and new{i}wörd" for i in range(40)] + EDGES
    ids, ends = model.encode_all(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode(t) for t in texts]
    assert sum(merged) < 100 and len(merged) <= 2  # one step for the short units, one for parts of the long ones


def test_long_units_are_cut_or_merged_alone(library):
    model = subwords.load(PATH)
    texts = ["中文é" * 200, "ab" * 100 + "\n" + "x" * 47 + " " + "x" * 48 + " " + "x" * 49, "😀" * 60 + "the" * 30, ""]
    ids, ends = model.encode_all(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [library.encode(t) for t in texts]
    assert all(model.decode(library.encode(t) + [2]) == library.decode(library.encode(t) + [2]) for t in texts)
    assert model.decode([2]) == library.decode([2]) and model.decode([]) == ""


def test_slices_are_bounded_by_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(subwords, "SLICE_ROWS", 3)
    monkeypatch.setattr(subwords, "SLICE_BYTES", 10)
    texts = ["a" * 4, None, "b" * 6, "c" * 11, "", None, "", "d"]
    batch = subwords.pa.RecordBatch.from_arrays([subwords.pa.array(texts, subwords.pa.string())], names=["text"])
    got = [part.column("text").to_pylist() for part in subwords.slices(batch)]
    assert got == [["a" * 4, None, "b" * 6], ["c" * 11], ["", None, ""], ["d"]]


def test_query_on_given_documents(spark, library):
    got = QUERIES["op11_sentencepiece"](spark, DATA).toPandas()
    docs = table(spark, DATA, "documents").select("doc_id", "text").toPandas()
    assert len(got) == len(docs) and got["library_agrees"].all()
    want = {r.doc_id: expected(library, r.text) for r in docs.itertuples()}
    for r in got.itertuples():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id]


def test_edges(spark, library):
    rows = [(1, None), (2, ""), (None, "null id"), (3, "same"), (3, "same"), *[(10 + i, t) for i, t in enumerate(EDGES)]]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    for name in ("ids", "n_tokens", "library_agrees", "text_2"):
        df = df.withColumn(name, F.lit(7))
    got = subwords.digests(subwords.encode(df, PATH)).collect()
    assert len(got) == len(rows) and all(r.library_agrees for r in got)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256) for r in got) == sorted(
        (i is None, i or 0, *expected(library, t)[:2]) for i, t in rows
    )
    assert [r.n_tokens for r in got if r.doc_id in (1, 2)] == [1, 1]


def test_empty_table(spark):
    assert subwords.digests(subwords.encode(spark.createDataFrame([], DOCS), PATH)).count() == 0
