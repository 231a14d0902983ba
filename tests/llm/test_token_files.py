"""Token files: round trip against the tokenizer library and views without copies."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tokenizers
from hypothesis import given, settings, strategies as st

from firmweave.llm import token_files as F
from firmweave.llm.common import Shared, read_files, scratch_path


@pytest.fixture(scope="module")
def definition():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def known(definition):
    return tokenizers.Tokenizer.from_str(definition)


ENCODERS = {}


def test_encoder_equals_the_library(definition, known, monkeypatch):
    texts = ["", "Hello  there's 1st\n\n x", "été où", "日本 ɐ", "<|endoftext|>a", "a <|endoftext|> b", "<|endoftext|><|endoftext", "é日 <|endoftext|>", "a\x1cb \xa0 c" * 30, "y" * 3000]
    for remembered in (500_000, 2):
        monkeypatch.setattr(F, "REMEMBERED", remembered)
        e = F.Encoder(definition, P.PATTERN)
        assert e.dtype == np.uint16 and e.splits_at(P.PATTERN)
        for limit in (500_000, 50):
            monkeypatch.setattr(F, "LONG_TEXT", limit)
            for t in texts * 2:
                assert np.frombuffer(e.encode(t), e.dtype).tolist() == known.encode(t, add_special_tokens=False).ids
    whole = F.Encoder(definition)
    assert np.frombuffer(whole.encode(texts[1]), "<u2").tolist() == known.encode(texts[1], add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x250), max_size=60))
def test_any_latin_text(definition, known, text):
    e = ENCODERS.setdefault("one", F.Encoder(definition, P.PATTERN))
    assert np.frombuffer(e.encode(text), e.dtype).tolist() == known.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file_ids", [4_000_000, 40])
def test_round_trip(spark, definition, known, file_ids):
    rows = [(i, f"text number {i} " * (i % 17)) for i in range(60, 0, -1)] + [(7, "twice"), (7, "twice"), (None, None), (80, "w " * 5000), (81, None)]
    rows += [(90, "a <|endoftext|> b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", __import__("pyspark").sql.functions.lit(1))
    encoder = Shared(spark, F.Encoder(definition, P.PATTERN))
    path = scratch_path(spark, "t")
    F.write_sequences(df, encoder, path, length=16, file_ids=file_ids)
    got = sorted(F.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    expected = {}
    for i, t in rows:
        expected.setdefault(i, []).append(known.encode(t or "", add_special_tokens=False).ids + [0])
    at = 0
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert ids in expected[r.doc_id] and r.n_tokens == len(ids) and r.start == at
        expected[r.doc_id].remove(ids)
        at += len(ids)
    assert not any(expected.values())


def test_views_share_the_bytes(spark, definition):
    df = spark.createDataFrame([(i, "some words here " * 40) for i in range(30)], "doc_id bigint, text string")
    encoder = spark.sparkContext.broadcast(F.Encoder(definition, P.PATTERN))
    path = scratch_path(spark, "t")
    F.write_sequences(df.coalesce(1), encoder, path, length=32)
    content = max((bytes(r.content) for r in read_files(spark, path).collect()), key=len)
    buffer = pa.py_buffer(content)
    file = F.TokenFile(buffer)
    for i in (0, len(file) // 2, len(file) - 1):
        tokens = file.tokens(i)
        assert len(tokens) == 32 and not tokens.flags.owndata
        assert buffer.address <= tokens.ctypes.data < buffer.address + buffer.size
    ids = file.info["ids"]
    assert sum(sum(file.mask(i).to_pylist()) for i in range(len(file))) == ids
    assert len(file) == -(-ids // 32)


def test_no_rows(spark, definition):
    encoder = spark.sparkContext.broadcast(F.Encoder(definition, P.PATTERN))
    path = scratch_path(spark, "t")
    F.write_sequences(spark.createDataFrame([], "doc_id bigint, text string"), encoder, path)
    assert F.read_documents(spark, path).count() == 0
