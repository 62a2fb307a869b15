import json
import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import packing as K

PATH = P.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
WORDS = K.WordIds(PATH)


def lib(text):
    return LIB.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="aB's \t\x1c\x85\xa0é́ı9#.,Σ", max_size=40)))
def test_word_by_word_equals_the_library(text):
    assert np.frombuffer(WORDS.encode(text), "<u4").tolist() == lib(text)


def test_special_tokens_and_other_pipelines_equal_the_library(tmp_path):
    texts = ["hello <|endoftext|> x", "<|startoftext|>a<|endoftext|><|endoftext|>", "<|EndOfText|> b<|endoftext|", "no\x1cne", "", "w" * 500 + " é" * 90]
    for t in texts:
        assert np.frombuffer(WORDS.encode(t), "<u4").tolist() == lib(t)
    other = json.loads(Tokenizer.from_file(PATH).to_str())
    other["normalizer"] = None
    (tmp_path / "other.json").write_text(json.dumps(other))
    words, library = K.WordIds(str(tmp_path / "other.json")), Tokenizer.from_file(str(tmp_path / "other.json"))
    for t in [*texts, "Ab cD"]:
        assert np.frombuffer(words.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_repeated_rows_are_dealt_to_all_shards(spark):
    n = 3000
    pieces = spark.range(n).selectExpr("CAST(NULL AS long) AS doc_id", "0 AS piece", "0L AS start", "700L AS length", "5L AS ids_crc32")
    rows = K.pack(pieces, 2048, shard=100).collect()
    assert len(rows) == n and len({(r.sequence_id, r.offset) for r in rows}) == n
    assert len({r.sequence_id >> 24 for r in rows}) > 20


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=200))
def test_bins_hold_no_more_than_the_capacity(sizes):
    sizes = np.array(sizes)
    bins = K.sum_of_squares(sizes, 64)
    assert np.bincount(bins, weights=sizes).max() <= 64 and len(bins) == len(sizes)


def _check(rows, docs, capacity):
    want = {}
    for doc_id, text in docs:
        ids = lib(text or "") + [0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            key = (doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
            want[key] = want.get(key, 0) + 1
    got, by = {}, {}
    for r in rows:
        key = tuple(r)[:5]
        got[key] = got.get(key, 0) + 1
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_every_piece_has_its_place(spark):
    docs = [(i, "the cat sat " * (i % 40)) for i in range(300)] + [(None, None), (5, "x"), (5, "x"), (7, "a b " * 900)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("text", "text")
    df = df.selectExpr("*", "doc_id AS sequence_id", "text AS piece")
    pieces = K.tokenise(df, PATH, 64)
    for shard in (10_000, 37):
        n = _check(K.pack(pieces, 64, shard=shard).collect(), docs, 64)
        total = sum(len(lib(t or "")) + 1 for _, t in docs)
        assert n <= 1.1 * total / 64 + 2


def test_empty_table(spark):
    assert K.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
