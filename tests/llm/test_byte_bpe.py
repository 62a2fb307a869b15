import base64
import hashlib

import public_tokenizers as P
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import byte_bpe as B

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = B.load_ranks(PATH)
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PAT = regex.compile(P.PATTERN)

texts = st.text(alphabet=st.sampled_from(list("abz 'srtev\n\t 19#é日<|>")), max_size=120)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_split_by_halves_equals_the_whole_split(text):
    assert B.split_text(text, PAT, leaf=5) == PAT.findall(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(texts, st.text(alphabet="aB'ds l9#\x1c\x1f\x00\t\x0b\n.\x85\xa0é", max_size=60)))
def test_faster_forms_split_alike(text):
    assert P.PATTERN == B.USUAL and [x for x in B.splitter(P.PATTERN)(text)] == PAT.findall(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdethis", max_size=300))
def test_long_pieces_equal_the_library(text):
    assert B.encode_piece(text.encode(), RANKS) == ENC.encode_ordinary(text) if text else True


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200))
def test_round_trip_of_any_text(text):
    ids = B.encode_text(text, PATH, P.PATTERN)
    assert ids == ENC.encode_ordinary(text)
    assert B.decode_ids(ids, PATH, P.PATTERN) == text.encode()


def test_runs_of_one_letter_and_of_blanks():
    for text in ("a" * 5000, " " * 9000, "\n" * 20000 + "x", "<|endoftext|>", "é" * 3000, "=" * 1000 + "ab" * 5000):
        assert B.encode_text(text, PATH, P.PATTERN) == ENC.encode_ordinary(text)


def test_query_rows(spark):
    rows = [(1, "the cat's " * 900), (2, None), (3, ""), (3, ""), (None, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = B.round_trip(df.withColumn("n_tokens", df.doc_id), PATH, P.PATTERN).collect()
    assert len(out) == 5
    for doc_id, text in rows:
        ids = ENC.encode_ordinary(text or "")
        want = (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert want in [tuple(r) for r in out]


def test_base64_file_is_complete():
    assert len(RANKS) == 50256 and base64.b64encode(b"!") and all(bytes([i]) in RANKS for i in range(256))
