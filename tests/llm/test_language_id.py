"""Language mixtures: held-out accuracy, known proportions, odd texts."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmweave.llm import language_id as L

SMALL = "/root/testdata/sf0.001"
SYLLABLES = {"aa": "ka ro mi tu ne so la".split(), "bb": "schn orf ügt ein ach pf".split(), "cc": "wor th ing ly ous ent".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def learnt(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, x, 60), x) for i, x in enumerate(["aa", "bb", "cc"] * 30)]
    rows += [(900, None, "aa"), (901, "words of no language", None), (902, "", "bb"), rows[0]]
    return rows, L.LanguageModel.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))


def test_counts_are_those_of_all_texts(spark, learnt):
    rows, model = learnt
    assert model.languages == ["aa", "bb", "cc"]
    for k, x in enumerate(model.languages):
        total = sum((L.grams(t) for _, t, lang in rows if lang == x and t is not None), np.zeros(L.BUCKETS, np.int64)) + 0.5
        assert np.allclose(model.probabilities[k], total / total.sum())


def test_proportions(learnt):
    _, model = learnt
    rng = random.Random(7)
    for a, b, share in (("aa", "bb", 0.7), ("cc", "aa", 0.6)):
        mixed = text(rng, a, int(1000 * share)) + " " + text(rng, b, int(1000 * (1 - share)))
        n = {x: L.grams(t).sum() for x, t in ((a, text(rng, a, int(1000 * share))), (b, text(rng, b, int(1000 * (1 - share)))))}
        found, score, shares = model.predict(mixed)
        assert found == max(n, key=n.get) and abs(score - max(n.values()) / sum(n.values())) < 0.05
        assert sum(s > 0 for s in shares) == 2 and abs(sum(shares) - 1) < 1e-6
    assert model.predict(text(rng, "bb", 40))[1] == 1.0


def test_em_finds_the_likeliest_shares(learnt):
    _, model = learnt
    rng = random.Random(9)
    counts = L.grams(text(rng, "aa", 300) + " " + text(rng, "cc", 500))
    at = np.flatnonzero(counts)

    def fit(share):
        return counts[at] @ np.log(share @ model.probabilities[:, at])

    best = max(((a / 200, 0, 1 - a / 200) for a in range(1, 200)), key=lambda s: fit(np.array(s)))
    assert np.abs(model.mixture(counts) - best).max() < 0.01


def test_odd_texts(learnt):
    _, model = learnt
    for odd in (None, "", " \n", "123 456 !!", "²³"):
        assert model.predict(odd)[:2] == ("und", 0.0)
    assert model.predict("k")[0] in model.languages
    assert model.predict("日本")[0] in model.languages
    assert L.LanguageModel([], np.zeros((0, L.BUCKETS))).predict("text")[:2] == ("und", 0.0)


def test_long_texts_are_counted_whole(monkeypatch):
    value = "some words and others " * 50
    whole = L.grams(value)
    monkeypatch.setattr(L, "BLOCK_CHARS", 100)
    assert abs(int(L.grams(value).sum()) - int(whole.sum())) <= 2 and np.abs(L.grams(value) - whole).sum() < 60


def test_columns(spark, learnt):
    _, model = learnt
    df = spark.createDataFrame([(1, "karomi", 5, "x"), (1, "karomi", 5, "x"), (None, None, None, None)], "doc_id bigint, text string, score int, languages string")
    got = L.identify(df, model, keep=["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [(0, "und"), (1, "aa"), (1, "aa")]
    assert L.identify(df.limit(0), model, keep=["doc_id"]).count() == 0
    none = L.LanguageModel.learn(df.limit(0).select("text", F.col("languages").alias("lang")))
    assert none.languages == [] and {r.lang_pred for r in L.identify(df, none, keep=["doc_id"]).collect()} == {"und"}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("held", F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    model = L.LanguageModel.learn(docs.filter("NOT held"))
    rows = L.identify(docs.filter("held"), model, keep=["lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.95
