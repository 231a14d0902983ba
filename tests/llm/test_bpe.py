"""Byte-level BPE against the tokenizer library and a plain merge loop."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from firmweave.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.BytePairTokenizer.from_file(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def known(tokenizer):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={})


TEXTS = [
    "", " ", "  a  b \n\n c", "The quick brown fox's 123,456 tails!!", "l'été où ça ñ ß", "日本語のテキスト 中文", "a\x1cb \x85 \xa0 c d",
    "x" * 5_000, "ab" * 3_000, "!?" * 500, " " * 300 + "end", "<|endoftext|> plain", "👩‍👩‍👧 ok", "ǅɏɐ Ⅷ² ½", "I'LL i'll we've", "᠎​﻿",
]


def test_perfect_hash_gives_each_key_its_slot():
    for n in (0, 1, 2, 7, 1000):
        keys = [f"k{i}".encode() for i in range(n)]
        h = bpe.PerfectHash(keys)
        assert sorted(h.order) == list(range(n))
        assert all(keys[h.order[h.slot(k)]] == k for k in keys)


def test_vocabulary_is_answered_by_the_hash(tokenizer):
    assert all(tokenizer.piece_ids(t) == [r] for t, r in list(tokenizer.ranks.items())[::50])


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_as_the_library(tokenizer, known, text):
    ids = np.frombuffer(tokenizer.encode(text), "<u4").tolist()
    assert ids == known.encode_ordinary(text)
    assert tokenizer.decode(np.array(ids, "<u4").tobytes()) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(tokenizer, known, text):
    assert np.frombuffer(tokenizer.encode(text), "<u4").tolist() == known.encode_ordinary(text)


def test_long_texts_and_full_memory(tokenizer, known, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    text = "Some words that repeat and some thhenable onesher. " * 20
    assert np.frombuffer(tokenizer.encode(text), "<u4").tolist() == known.encode_ordinary(text)


def test_frequent_pieces_stay_when_the_memory_is_full(tokenizer, known, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    own = bpe.BytePairTokenizer(tokenizer.ranks, public_tokenizers.PATTERN)
    merged, merge = [], own.merge
    own.merge = lambda piece: merged.append(piece) or merge(piece)
    for i in range(60):
        text = f" thhenable{'abc'[i % 3]} onesherq" + "".join(f" zq{c}{i}xv" for c in "klm")
        assert np.frombuffer(own.encode(text), "<u4").tolist() == known.encode_ordinary(text)
    assert merged.count(b" onesherq") == 1 and merged.count(b" thhenablea") == 1
    assert len(own._prepared[2]) + len(own._prepared[2].older) <= 40


def test_columns(spark, tokenizer, known):
    shared = bpe.share(spark, tokenizer)
    rows = [(1, "one two", "a"), (1, "one two", "a"), (2, None, None), (None, "", "b"), (3, "été" * 200, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, decoded string")
    encoded = bpe.encode_texts(df.drop("decoded"), shared)
    back = bpe.decode_ids(encoded, shared).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in back) == sorted((i or 0, (t or "").encode()) for i, t, _ in rows)
    for r in back:
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == known.encode_ordinary(bytes(r.decoded).decode())
    at_once = bpe.encode_and_decode(df, shared, keep=["doc_id"])
    assert at_once.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(repr, ((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in at_once.collect()))) == sorted(map(repr, ((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in back)))
    assert bpe.encode_texts(df.limit(0), shared).count() == 0
    assert set(bpe.encode_texts(df, shared, out="text", keep=["doc_id"]).columns) == {"doc_id", "text"}
