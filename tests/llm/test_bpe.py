import hashlib
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nivalis.llm import bpe

pytest.importorskip("tokenizers")

TEXTS = ["a \n b", "x <|endoftext|>  foo\n\n\n bar  \n", None, " ", "", "don't  we'll \r\n\t12 34!!  　 z q \x1c\x1d k", "ab" * 3000 + " émoji 😀 ​ x", "  <|endoftext|><|endoftext|>tail<|endoft \x85 ok", " \n", "The the THE the,", "a  \n b\n"]


def want(text):
    known = bpe.tokenizer(bpe.default_path())
    ids = known.encode(text or "", add_special_tokens=False).ids
    back = known.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_report_equals_the_tokenizer(spark):
    rows = [(i, t, "w", 3) for i, t in enumerate(TEXTS)] + [(None, "x y", "w", 3), (1, TEXTS[1], None, None)]
    got = bpe.encoding_report(spark.createDataFrame(rows, "doc_id long, text string, words string, block int")).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, map(tuple, got))) == sorted(key((i, *want(t))) for i, t, *_ in rows)


def test_encode_and_decode_round_trip(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(df)).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


def test_empty(spark):
    assert bpe.encoding_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\t\r\x0b\x0c\x85\xa0　 'sé1!<|>\x1c"), max_size=30))
def test_words_are_encoded_as_the_whole(text):
    known = bpe.tokenizer(bpe.default_path())
    words = bpe.split_words(text.encode())
    assert b"".join(words).decode() == text
    ids = [i for w in words for i in known.encode(w.decode(), add_special_tokens=False).ids]
    assert ids == known.encode(text, add_special_tokens=False).ids
